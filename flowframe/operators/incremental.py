"""Change-driven operators over explicit snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowframe.operators.columns import quoted
from flowframe.operators.events import current_state
from flowframe.operators.relational import anti_join_null_safe, join, union_ragged


@dataclass(frozen=True)
class TimeView:
    """A table at one pull: the rows known before it, and the rows it added."""

    previous: DataFrame
    new: DataFrame

    @property
    def all(self) -> DataFrame:
        return self.previous.unionByName(self.new)


def new_rows(
    current: DataFrame,
    previous: DataFrame,
    ts: str | None = None,
    till: str | None = None,
    ignore: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of `current` up to `till` that the previous snapshot lacks, and the next snapshot.

    Without `ignore` the difference is a set difference. With it, the named (timestamp)
    columns are not compared, null equals null and differing column sets are widened.
    """
    seen = current.filter(F.col(ts) <= F.lit(till)) if ts and till else current
    if ignore is None:
        fresh = seen.subtract(previous)
        return fresh, previous.unionByName(fresh)
    fresh = anti_join_null_safe(seen, previous, ignore)
    return fresh, union_ragged(previous, fresh)


def timed_table(current: DataFrame, previous: DataFrame, ts: str | None, till: str) -> TimeView:
    """`new_rows` over any upstream table; without a timestamp the whole table is compared."""
    fresh, _ = new_rows(current, previous, ts, till if ts else None)
    return TimeView(previous, fresh)


def join_delta(
    left_previous: DataFrame, left_new: DataFrame, right_all: DataFrame, right_new: DataFrame, cols: Sequence[str]
) -> DataFrame:
    """The rows an inner join gains: old left with new right, plus new left with all right."""
    return join(left_previous, right_new, cols).unionByName(join(left_new, right_all, cols))


def join_views(left: TimeView, right: TimeView, cols: Sequence[str]) -> TimeView:
    """Inner join of two views as a view, so deltas run through any number of joins."""
    return TimeView(
        join(left.previous, right.previous, cols),
        join_delta(left.previous, left.new, right.all, right.new, cols),
    )


def union_delta(left: TimeView, right: TimeView) -> TimeView:
    return TimeView(left.previous.unionByName(right.previous), left.new.unionByName(right.new))


def propagate_changes(first: TimeView, steps: Iterable[tuple[TimeView, Sequence[str]]]) -> TimeView:
    """Changed rows of a multi-way inner join, touching only what the changes reach."""
    return reduce(lambda acc, step: join_views(acc, step[0], step[1]), steps, first)


def catch_up(df: DataFrame, ts: str, history_till: str, now: str, step: str = "1 day", out: str = "pull") -> DataFrame:
    """Number each row with the pull that first delivers it.

    Pull 0 is the history up to `history_till`; pull n covers the n-th step after it, up to
    `now`. Rows after `now` are not yet visible. One pass replaces a loop of daily pulls.
    """
    width = f"(unix_micros(timestamp '1970-01-01 00:00:00Z' + INTERVAL {step}))"
    start = f"unix_micros(CAST(timestamp '{history_till}' AS TIMESTAMP))"
    here = f"unix_micros(CAST(`{ts}` AS TIMESTAMP))"
    pull = f"CASE WHEN {here} <= {start} THEN 0L ELSE CAST(ceil(({here} - {start}) / {width}) AS BIGINT) END"
    return df.filter(F.col(ts) <= F.expr(f"timestamp '{now}'")).withColumn(out, F.expr(pull))


def resume_from_landed(landed: DataFrame, keys: Sequence[str], ts: str) -> TimeView:
    """Start from the current state of landed output and report nothing as new."""
    state = current_state(landed, keys, ts)
    return TimeView(state, state.limit(0))


class SnapshotStore:
    """Durable state, one directory per batch id.

    The directories hold whole snapshots (`save`, `latest`), or only what each batch added
    (`save`, `known`), which spares writing a large table again for every pull. A directory
    counts once Spark has written its success marker; a batch that is run again overwrites its
    own, so replays are idempotent and readers never see half of one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _done(self) -> list[int]:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop_path):
            return []
        found = []
        for status in fs.listStatus(hadoop_path):
            name = status.getPath().getName()
            if name.startswith("batch=") and fs.exists(
                self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            ):
                found.append(int(name.split("=", 1)[1]))
        return sorted(found)

    def latest(self, before: int | None = None) -> DataFrame | None:
        """The newest finished snapshot, or the newest one older than batch `before`."""
        done = [b for b in self._done() if before is None or b < before]
        return self.spark.read.parquet(f"{self.path}/batch={done[-1]}") if done else None

    def known(self, before: int | None = None, schema: StructType | None = None) -> DataFrame | None:
        """All rows of the finished batches, or of those older than batch `before`; with a schema
        also where batches are laid out by a column."""
        done = [f"{self.path}/batch={b}" for b in self._done() if before is None or b < before]
        if not done:
            return None
        if schema is None:
            return self.spark.read.parquet(*done)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*done).select(*schema.names)

    def save(self, df: DataFrame, batch_id: int, by: str | None = None) -> DataFrame:
        """Write the rows of a batch, in directories by the column `by` where it is given."""
        target = f"{self.path}/batch={batch_id}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)


class MonthStore:
    """What pulls of a table laid out by month have delivered, and a manifest of its months.

    The manifest has, for each month, a digest of its files (path, length, time) and one of its
    rows: their number, and the sum of their hashes, which doesn't depend on their order. A pull
    lists the files, digests the rows of months whose files differ, and compares the rows of
    those whose digest differs; other months are not read. A batch that is run again sees what was
    known before it, and replaces its own. The driver holds one line for each month.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.rows = SnapshotStore(spark, f"{path.rstrip('/')}/rows")
        self.manifests = SnapshotStore(spark, f"{path.rstrip('/')}/months")

    def pull(self, current: DataFrame, month: str, batch_id: int, ignore: Sequence[str] | None = None) -> DataFrame:
        """The rows of `current` that earlier batches lack, as in `new_rows`.

        `current` must be read from files in directories of the column `month`, as it is now. Rows
        without a month are a month like others. Columns in `ignore` are not compared. When the
        compared columns are others than before, every month counts as different.
        """
        compared = [c for c in current.columns if c != month and c not in (ignore or ())]
        shape = current.select(*compared).schema.simpleString()
        before = self.manifests.latest(before=batch_id)
        known = {r["month"]: r for r in before.collect() if r["shape"] == shape} if before is not None else {}
        listed = {r["month"]: r["files"] for r in file_digests(current, month).collect()}
        moved = [m for m, files in listed.items() if m not in known or known[m]["files"] != files]
        read = {r["month"]: (r["n"], r["content"]) for r in row_digests(of_months(current, month, moved), month, compared).collect()}
        differ = [m for m in moved if m not in known or (known[m]["n"], known[m]["content"]) != read[m]]
        some, past = of_months(current, month, differ), self.rows.known(batch_id, current.schema)
        if past is None:
            gained = some.distinct() if ignore is None else some
        else:
            gained, _ = new_rows(some, of_months(past, month, differ), ignore=ignore)
        fresh = self.rows.save(gained.select(*[c for c in current.columns if c != month], month), batch_id, by=month)
        lines = [(m, files, *(read[m] if m in read else (known[m]["n"], known[m]["content"])), shape) for m, files in listed.items()]
        fields = "month string, files decimal(38,0), n long, content decimal(38,0), shape string"
        self.manifests.save(current.sparkSession.createDataFrame(lines, fields), batch_id)
        return fresh.select(*current.columns)


def of_months(df: DataFrame, month: str, months: Sequence[str | None]) -> DataFrame:
    """The rows of some months, as a filter that directories are chosen by."""
    named = [m for m in months if m is not None]
    kept = F.col(month).cast("string").isin(named) if named else F.lit(False)
    return df.filter(kept | F.col(month).isNull() if None in months else kept)


def file_digests(df: DataFrame, month: str) -> DataFrame:
    """month and files: a sum of hashes of the month's files. No column of the files is read."""
    file = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = df.select(F.col(month).cast("string").alias("month"), file.alias("h")).distinct()
    return files.groupBy("month").agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("files"))


def row_digests(df: DataFrame, month: str, compared: Sequence[str]) -> DataFrame:
    """month, n and content: the number of rows and a sum of their hashes."""
    rows = df.select(F.col(month).cast("string").alias("month"), F.xxhash64(*[F.col(quoted(c)) for c in compared]).alias("h"))
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("content"))
