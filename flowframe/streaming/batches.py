"""Micro-batch runs: map, write, keep raw input, audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowframe.operators.cells import batch_last_write_wins, mapped_cells
from flowframe.operators.mapping import ID, MESSAGE, REJECT, ROW, MappedFrames, map_tagged, split_tagged
from flowframe.operators.relational import partition_sort
from flowframe.operators.windows import ordered_neighbours

Sink = Callable[[DataFrame, int], None]


def run_batches(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Call `process` for each micro-batch; without an interval, for what is available now.

    A batch may be run again after a failure under the same id, so `process` should write
    idempotently (see `write_batch`).
    """
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def write_batch(df: DataFrame, path: str, batch_id: int, partition_cols: Sequence[str] = ()) -> None:
    """Write a batch to its own directory; a repeated batch replaces it."""
    writer = df.write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def mapping_batch(
    spec: dict,
    sinks: Sequence[Sink],
    audit_path: str | None = None,
    raw: Sink | None = None,
    doc_ids: Sink | None = None,
    topic_col: str = "topic",
    value_col: str = "value",
    last_write: bool = False,
    topic: str | None = None,
    sort_path: str | None = None,
    rejects: Sink | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function: map documents, order rows for the writers, write, keep raw, audit.

    `topic` takes the topic from each message (see `map_tagged`) instead of from `topic_col`, and
    `sort_path` puts messages in the order of a number in them, which decides between rows of one
    sort key; messages without it are rejected. `doc_ids` is a sink for the ids of the batch's
    documents, `rejects` one for the messages left out. Sinks get the mapped rows in order;
    rows of one key may run over several tasks, so a sink that applies them one by one must
    compare sort keys. With `last_write` sinks get cells instead, one for each table, key, family
    and qualifier: that of the highest sort key, in any order.

    A message is parsed and mapped once; rows, ids, rejects and counts are parts of one frame.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if raw is not None else batch
        tagged = map_tagged(kept, spec, topic, sort_path, topic_col, value_col).persist()
        mapped = split_tagged(tagged)
        try:
            if last_write:
                cell = ["table_name", "row_key", "family", "qualifier"]
                made = mapped.rows.drop("order") if sort_path is None else mapped.rows.withColumn("sort_key", _placed("sort_key", "order")).drop("order")
                written = batch_last_write_wins(mapped_cells(made), cell, "ts")
            else:
                order = ["sort_key"] if sort_path is None else ["sort_key", "order"]
                written = partition_sort(mapped.rows, ["table_name", "row_key"], order).drop("order")
            for sink in sinks:
                sink(written, batch_id)
            if raw is not None:
                raw(kept, batch_id)
            if doc_ids is not None:
                doc_ids(mapped.doc_ids, batch_id)
            if rejects is not None:
                rejects(mapped.rejects, batch_id)
            if audit_path:
                write_batch(tagged_audit(tagged, batch_id), audit_path, batch_id)
        finally:
            tagged.unpersist()
            if raw is not None:
                kept.unpersist()

    return process


def _placed(sort_key: str, order: str) -> Column:
    """A sort key that goes on with the number of its message, in a form that texts compare by."""
    shifted = F.col(order).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return F.concat_ws("-", F.col(sort_key), F.lpad(shifted.cast("string"), 20, "0"))


def tagged_audit(tagged: DataFrame, batch_id: int) -> DataFrame:
    """One row per topic, as in `batch_audit`, from one aggregation over what a mapping made."""
    of = lambda kind: F.count_if(F.col("kind") == kind)
    return tagged.groupBy("topic").agg(
        of(MESSAGE).alias("messages"),
        of(ROW).alias("rows"),
        F.count_distinct(F.when(F.col("kind") == ID, F.struct("doc_id"))).alias("documents"),
        of(REJECT).alias("rejected"),
    ).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def batch_audit(
    batch: DataFrame, mapped: MappedFrames, batch_id: int, rows: DataFrame | None = None, topic_col: str = "topic"
) -> DataFrame:
    """One row per topic: messages read, rows made, documents seen, messages rejected."""

    def counted(df: DataFrame, name: str, topic: str = "topic") -> DataFrame:
        return df.groupBy(F.col(topic).alias("topic")).agg(F.count("*").alias("n")).select("topic", F.lit(name).alias("what"), "n")

    told = (
        counted(batch, "messages", topic_col)
        .unionByName(counted(rows if rows is not None else mapped.rows, "rows"))
        .unionByName(counted(mapped.doc_ids, "documents"))
        .unionByName(counted(mapped.rejects, "rejected"))
    )
    columns = ["messages", "rows", "documents", "rejected"]
    sums = [F.coalesce(F.sum(F.when(F.col("what") == c, F.col("n"))), F.lit(0)).alias(c) for c in columns]
    return told.groupBy("topic").agg(*sums).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def offset_ranges(batch: DataFrame, batch_id: int, keys: Sequence[str] = ("topic", "partition")) -> DataFrame:
    """Rows of the offset log for one batch of bus messages (with their `offset`)."""
    return batch.groupBy(*keys).agg(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
    )


def offset_gaps(offsets: DataFrame, keys: Sequence[str] = ("topic", "partition"), block: int = 1000) -> DataFrame:
    """Entries of an offset log that do not start where the one before them ended.

    The log holds one row per batch and bus partition: (topic, partition, batch_id,
    from_offset, until_offset). It is walked in blocks of batch ids, so the log of one
    partition is spread over tasks.
    """
    told = ordered_neighbours(
        offsets,
        keys,
        ["batch_id"],
        F.expr(f"batch_id div {block}"),
        following={"__batch": "batch_id", "__from": "from_offset"},
    )
    return told.filter("__from <> until_offset").select(
        *keys, F.col("__batch").alias("batch_id"), F.col("__from").alias("from_offset"), F.col("until_offset").alias("expected")
    )


def pending_runs(finished: DataFrame, started: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Finished folders whose rules have not been started yet."""
    return finished.join(started.select(*keys).distinct(), list(keys), "left_anti")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
