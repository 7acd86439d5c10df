"""Landing of raw CSV drops with data-quality verdicts per file.

Files of one drop may differ in their headers. Their header lines are found by one text scan,
files are grouped by header, and each group is one native CSV read: the plan grows with the
number of different headers, not with the number of files.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from zoneinfo import available_timezones

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.functions.timestamps import check_pattern, derive_ts
from flowframe.operators.columns import quoted, safe_name
from flowframe.operators.events import dedup_oldest
from flowframe.operators.incremental import TimeView, new_rows, resume_from_landed
from flowframe.operators.relational import union_ragged

FILE = "__file"
CORRUPT = "__corrupt"
TAGS = ["FILENAME_TS", "LAST_MODIFIED_TS", "DERIVED_TS", "PARSE_ERROR"]
# columns that never tell two rows apart, beside the source timestamps
STAMPS = [*TAGS, "yearmonth", "daytimestamp"]
MODIFIED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# error types of a file
MISSING_KEYS = "missing_key_columns"
DUPLICATE_COLUMNS = "duplicate_columns"
MISSING_TS = "missing_timestamp_columns"
BAD_TS = "unparsable_timestamp"
MALFORMED = "malformed_rows"


@dataclass(frozen=True)
class Landed:
    """Landed rows, rows of failed files with their error, and one verdict per file."""

    rows: DataFrame
    quarantine: DataFrame
    verdicts: DataFrame


@dataclass(frozen=True)
class HeaderGroup:
    """Files that share one header line."""

    header: str
    names: list[str]
    paths: list[str]

    @property
    def columns(self) -> list[str]:
        """A name for each position: blank ones become `_c<position>`, repeated ones get theirs as a suffix."""
        out: list[str] = []
        for i, n in enumerate(self.names):
            plain = n if n.strip() else f"_c{i}"
            out.append(plain if plain not in out else f"{plain}_{i}")
        return out

    @property
    def blanks(self) -> list[str]:
        """The columns whose name was blank."""
        return [c for c, n in zip(self.columns, self.names, strict=True) if not n.strip()]

    @property
    def duplicates(self) -> list[str]:
        given = [n for n in self.names if n.strip()]
        return sorted({n for n in given if given.count(n) > 1})


def header_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file path, first line) of every file that is not empty.

    Within one task lines keep their order, so the first line of a file is the one with the
    smallest row id among the lines of its first block. The minimum is combined per task.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path if isinstance(path, str) else list(path))
    first = lines.filter("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("id")
    )
    return first.groupBy("path").agg(F.min_by("value", "id").alias("header"))


def opened_header_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """`header_lines` by opening each file on the executors and reading one line.

    For file systems that Python on the executors can reach (shared mounts, and the stores
    pyarrow knows and has credentials for). The files are listed without their contents.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = listed.load(path if isinstance(path, str) else list(path)).filter("length > 0").select("path")

    def first_lines(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "header": [first_line(p) for p in batch["path"]]})

    # a given number of partitions is kept: paths are few bytes, and would be merged into one task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInPandas(first_lines, "path string, header string")


def first_line(path: str) -> str:
    system, inside = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    with system.open_input_stream(inside) as stream:
        return io.TextIOWrapper(stream, encoding="utf-8").readline().rstrip("\r\n")


def header_groups(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    first_file_only: bool = False,
    open_files: bool = False,
) -> list[HeaderGroup]:
    """Files grouped by header. The driver learns file paths, as a file listing does."""
    found = opened_header_lines(spark, path) if open_files else header_lines(spark, path)
    if first_file_only:
        found = found.orderBy("path").limit(1)
    groups: dict[str, list[str]] = {}
    for row in found.toLocalIterator():
        groups.setdefault(row["header"], []).append(row["path"])
    return [
        HeaderGroup(header, next(csv.reader([header.rstrip("\r")], delimiter=sep)), sorted(paths))
        for header, paths in sorted(groups.items())
    ]


def static_verdict(group: HeaderGroup, keys: Sequence[str], src_ts: Sequence[str]) -> tuple[str, str] | None:
    """What a header alone can tell: missing keys, duplicate names, missing timestamp columns."""
    listed = ",".join(group.names)
    if not set(keys) <= set(group.names):
        return MISSING_KEYS, f"columns {listed} lack key columns {','.join(k for k in keys if k not in group.names)}"
    if group.duplicates:
        return DUPLICATE_COLUMNS, f"duplicate columns {','.join(group.duplicates)}"
    if not set(src_ts) <= set(group.names):
        return MISSING_TS, f"columns {listed} lack timestamp columns {','.join(c for c in src_ts if c not in group.names)}"
    return None


def read_group(spark: SparkSession, group: HeaderGroup, sep: str) -> DataFrame:
    """All rows of a group as text, tagged with their file; blank names become `_c<position>`.

    Repeated names get their position as a suffix. A row with too few or too many values is
    kept with its text in the corrupt column.
    """
    names = group.columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    df = (
        spark.read.schema(schema)
        .options(header="true", sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema="true")
        .option("columnPruning", "false")  # a pruned parse does not count the values of a row
        .csv(group.paths)
    )
    return df.select(
        *[F.col(quoted(n)) for n in [*names, CORRUPT]],
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_name").alias("FILENAME_TS"),
        F.date_format("_metadata.file_modification_time", MODIFIED_FORMAT).alias("LAST_MODIFIED_TS"),
    )


def drop_blank_headers(df: DataFrame, group: HeaderGroup) -> DataFrame:
    """Without the columns whose header was blank in the group's files."""
    return df.drop(*group.blanks)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only rows with all keys; a key column the frame lacks is null everywhere."""
    missing = {k: F.lit(None).cast("string") for k in keys if k not in df.columns}
    return (df.withColumns(missing) if missing else df).dropna(subset=list(keys))


def with_derived_ts(df: DataFrame, src_ts: Sequence[str], pattern: str, zone: str) -> DataFrame:
    if not src_ts:
        return df.withColumns(
            {
                "DERIVED_TS": F.lit(None).cast("string"),
                "PARSE_ERROR": F.lit("no timestamp columns were named"),
            }
        )
    parsed = df.withColumn("__ts", derive_ts([F.col(quoted(c)) for c in src_ts], pattern, zone))
    return parsed.withColumns({"DERIVED_TS": F.col("__ts.ts"), "PARSE_ERROR": F.col("__ts.error")}).drop("__ts")


def data_verdicts(rows: DataFrame) -> DataFrame:
    """Per file: what its rows tell. One aggregation, combined per task."""
    told = rows.groupBy(FILE).agg(
        F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_rows"),
        F.count_if(F.col(CORRUPT).isNull() & F.col("DERIVED_TS").isNull()).alias("bad_ts"),
    )
    kind = F.when(F.col("bad_rows") > 0, F.lit(MALFORMED)).when(F.col("bad_ts") > 0, F.lit(BAD_TS))
    text = F.when(F.col("bad_rows") > 0, F.concat(F.col("bad_rows").cast("string"), F.lit(" malformed rows"))).when(
        F.col("bad_ts") > 0, F.concat(F.lit("no timestamp for "), F.col("bad_ts").cast("string"), F.lit(" rows"))
    )
    return told.select(FILE, kind.alias("error_type"), text.alias("error"))


def land_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    keys: Sequence[str],
    src_ts: Sequence[str],
    pattern: str,
    zone: str = "UTC",
    cols: Mapping[str, str] | None = None,
    sep: str = ",",
    first_file_only: bool = False,
    open_files: bool = False,
) -> Landed:
    """Read a drop of raw CSV files into timestamped rows.

    A file fails as a whole when its header lacks a key or timestamp column or repeats a
    name, or when any row is malformed or has no derivable timestamp. Rows of the others are
    kept when all keys are given, tagged with file and timestamps, brought to safe column
    names, chosen and renamed by `cols`, and freed of duplicates, the oldest staying. Rows
    that differ in nothing but timestamps (source or derived) and file tags are duplicates.

    Headers are found by a text scan of the drop, which any file system allows; `open_files`
    reads only one line per file where the executors' Python can open the files.
    """
    if not keys:
        raise ValueError("key columns have not been specified")
    if not src_ts:
        raise ValueError("source timestamp columns have not been specified")
    check_pattern(pattern)
    if zone not in available_timezones():
        raise ValueError(f"timezone {zone!r} is not valid")

    groups = header_groups(spark, path, sep, first_file_only, open_files)
    if not groups:
        raise ValueError(f"no data under {path}")
    readable, failed, verdicts = [], [], []
    for group in groups:
        verdict = static_verdict(group, keys, src_ts)
        df = read_group(spark, group, sep)
        if verdict:
            told = df.withColumns({"__errortype__": F.lit(verdict[0]), "__error__": F.lit(verdict[1])})
            failed.append(told)
            verdicts += [(p, verdict[0], verdict[1]) for p in group.paths]
        else:
            readable.append(with_derived_ts(drop_blank_headers(df, group), src_ts, pattern, zone))
            verdicts += [(p, None, None) for p in group.paths]
    listed = spark.createDataFrame(verdicts, f"{FILE} string, error_type string, error string")
    if not readable:
        empty = failed[0].limit(0).select(F.lit(None).cast("string").alias("DERIVED_TS"))
        bad = reduce(union_ragged, failed).drop(CORRUPT)
        return Landed(empty, bad, listed.withColumnRenamed(FILE, "path"))

    rows = reduce(union_ragged, readable)
    told = data_verdicts(rows)
    broken = told.filter("error_type IS NOT NULL")
    good = rows.join(broken.select(FILE), FILE, "left_anti").drop(CORRUPT, FILE)
    good = safe_names(require_keys(good, keys))
    if cols:
        keep = [F.col(safe_name(src)).alias(name) for src, name in cols.items()]
        good = good.select(*keep, *TAGS)
    good = good.drop("PARSE_ERROR")
    named = [cols[c] for c in src_ts if c in cols] if cols else [safe_name(c) for c in src_ts]
    landed = dedup_oldest(good, "DERIVED_TS", ignore=uncompared(good, named))

    bad_rows = rows.join(broken, FILE).withColumnsRenamed({"error_type": "__errortype__", "error": "__error__"})
    quarantine = reduce(union_ragged, [*failed, bad_rows]).drop(CORRUPT)
    verdict_rows = (
        listed.alias("l")
        .join(told.alias("t"), FILE, "left")
        .select(
            F.col(FILE).alias("path"),
            F.coalesce("l.error_type", "t.error_type").alias("error_type"),
            F.coalesce("l.error", "t.error").alias("error"),
        )
    )
    return Landed(landed, quarantine, verdict_rows)


def safe_names(df: DataFrame) -> DataFrame:
    """Safe column names; tag and internal columns keep theirs."""
    return df.withColumnsRenamed({c: safe_name(c) for c in df.columns if c != safe_name(c)})


def uncompared(df: DataFrame, src_ts: Sequence[str]) -> list[str]:
    """Timestamp and tag columns of a frame, apart from the derived timestamp."""
    return [c for c in df.columns if c in src_ts or (c in STAMPS and c != "DERIVED_TS")]


def land_newest(
    landed: DataFrame,
    previous: DataFrame,
    till: str | None = None,
    src_ts: Sequence[str] = (),
    whole_days: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Landed rows that differ from the previous snapshot in more than their timestamps.

    `till` (yyyy-MM-dd, with or without a time) bounds the derived timestamp. A day counts to
    its end; without `whole_days` it is compared as text, which leaves out the day itself.
    """
    ignored = [*uncompared(landed, src_ts), *[c for c in ["DERIVED_TS"] if c in landed.columns]]
    if till and whole_days and len(till) == 10:
        landed, till = landed.filter(F.col("DERIVED_TS") < str(date.fromisoformat(till) + timedelta(days=1))), None
    return new_rows(landed, previous, "DERIVED_TS" if till else None, till, ignore=ignored)


def land_initial(
    spark: SparkSession,
    root: str,
    start: str,
    till: str,
    keys: Sequence[str],
    src_ts: Sequence[str],
    pattern: str,
    **options,
) -> Landed:
    """The drops of the months from `start` to `till` (yyyyMM, or yyyyMMdd) under `root/YYYY/MM`, landed as one.

    A row that came in several months stays with its oldest timestamp. Where `till` names a day,
    rows after it are left out. Further options are those of `land_csv`.
    """
    paths = month_paths(spark, root, start, till)
    if not paths:
        raise ValueError(f"no data under {root} from {start} to {till}")
    landed = land_csv(spark, paths, keys, src_ts, pattern, **options)
    if len(till) < 8:
        return landed
    return Landed(landed.rows.filter(F.col("DERIVED_TS") < day_after(till)), landed.quarantine, landed.verdicts)


def day_after(day: str) -> str:
    """The day after yyyyMMdd, as derived timestamps begin."""
    return str(date(int(day[:4]), int(day[4:6]), int(day[6:8])) + timedelta(days=1))


def recent_months(today: date, months: int = 12) -> tuple[str, str]:
    """The span of a whole load: from the month `months` ago to the last day of this month."""
    ago = today.year * 12 + today.month - 1 - months
    following = date(today.year + today.month // 12, today.month % 12 + 1, 1)
    return f"{ago // 12}{ago % 12 + 1:02d}", (following - timedelta(days=1)).strftime("%Y%m%d")


def land_resumed(landed: DataFrame, clean: DataFrame, keys: Sequence[str], src_ts: Sequence[str] = (), ts: str = "DERIVED_TS") -> TimeView:
    """Rows of a drop that the current state of what was landed before doesn't have.

    `clean` is the landed output of earlier runs. Its freshest row of each key is the state to go on
    from, and rows that differ from it in timestamps alone are not new.
    """
    state = resume_from_landed(clean, keys, ts).previous
    return TimeView(state, land_newest(landed, state, src_ts=src_ts)[0])


def month_paths(spark: SparkSession, root: str, start: str, till: str) -> list[str]:
    """Existing `root/YYYY/MM/*` directories of the months from `start` to `till` (yyyyMM...)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    year, month = int(start[:4]), int(start[4:6])
    while f"{year}{month:02d}" <= till[:6]:
        pattern = hadoop.Path(f"{root.rstrip('/')}/{year}/{month:02d}/*")
        store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        found += [s.getPath().toString() for s in store.globStatus(pattern) or []]
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return found


def embargo_files(spark: SparkSession, verdicts: DataFrame, root: str) -> int:
    """Move failed files to a sibling `<root>_embargo` tree; returns how many were moved."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    base = hadoop.Path(root)
    store = base.getFileSystem(conf)
    base_uri = store.makeQualified(base).toString().rstrip("/")
    moved = 0
    for row in verdicts.filter("error_type IS NOT NULL").toLocalIterator():
        source = store.makeQualified(hadoop.Path(row["path"]))
        inside = source.toString()[len(base_uri) :].lstrip("/")
        target = hadoop.Path(f"{base_uri}_embargo/{inside}")
        store.mkdirs(target.getParent())
        moved += bool(store.rename(source, target))
    return moved
