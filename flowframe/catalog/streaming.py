"""Queries of micro-batch work: files and messages run to their end, results read back."""

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.catalog.mapping import DETAILS, MESSAGES, messages
from flowframe.operators import mapping
from flowframe.session import scratch_dir
from flowframe.streaming import batches, files
from flowframe.streaming.upserts import upsert_stream


def dropped(spark, data, parts=6):
    """Events as several JSON files."""
    path = scratch_dir(spark, "incoming")
    df = table(spark, data, "events").select("event_id", "user_id", "event_type")
    df.repartition(parts, "event_id").write.json(path)
    return path


SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING"


@query("new_files", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def new_files(spark, data):
    """Rows of the files that a processed-file table does not name yet."""
    path = scratch_dir(spark, "incoming")
    df = table(spark, data, "events").select("event_id", "event_type")
    for kind in ("click", "view"):
        df.filter(F.col("event_type") == kind).write.mode("append").json(path)
    seen_path = scratch_dir(spark, "incoming")
    df.filter("event_type = 'error'").write.json(seen_path)
    listed = files.list_files(spark, path, "*.json").unionByName(files.list_files(spark, seen_path, "*.json"))
    fresh = files.new_files(listed, files.list_files(spark, seen_path, "*.json"))
    rows = spark.read.schema("event_id BIGINT, event_type STRING").json([path, seen_path])
    tagged = rows.select("*", F.col("_metadata.file_path").alias("uri"))
    # the listing names a path "file:/x", the scan "file:///x"
    plain = F.regexp_replace("uri", "^([a-z]+:)/+", "$1/")
    paths = fresh.select(F.regexp_replace("path", "^([a-z]+:)/+", "$1/").alias("path"))
    return tagged.withColumn("path", plain).join(paths, "path", "left_semi").select("event_id", "event_type")


@query("settled_files", "SELECT 6::BIGINT AS settled, 0::BIGINT AS unsettled, 6::BIGINT AS named")
def settled_files(spark, data):
    """Files count once they have been left alone for the settle time."""
    listed = files.list_files(spark, dropped(spark, data), "*.json")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    later = files.settled(listed, now + timedelta(seconds=700))
    early = files.settled(listed, now - timedelta(seconds=10))
    named = files.matching(listed, r"part-.*\.json", "incoming-")
    kinds = {"settled": later, "unsettled": early, "named": named}
    every = reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind")) for k, df in kinds.items()])
    return every.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])


@query("file_stream", "SELECT event_id, user_id, event_type FROM events")
def file_stream(spark, data):
    """All files, two per batch, each written under its batch id."""
    out, checkpoint = scratch_dir(spark, "streamed"), scratch_dir(spark, "stream-checkpoint")
    stream = files.file_stream(spark, dropped(spark, data), "json", SCHEMA, pattern="*.json", max_files=2)
    batches.run_batches(stream, lambda df, i: batches.write_batch(df, out, i), checkpoint).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("file_stream_resume", "SELECT event_id, user_id, event_type FROM events")
def file_stream_resume(spark, data):
    """A second run under the same checkpoint reads only what came after the first."""
    path, out, checkpoint = (scratch_dir(spark, n) for n in ("incoming", "streamed", "stream-checkpoint"))
    df = table(spark, data, "events").select("event_id", "user_id", "event_type")
    for kinds in (["click", "view"], ["error", "purchase", "signup"]):
        df.filter(F.col("event_type").isin(kinds)).write.mode("append").json(path)
        stream = files.file_stream(spark, path, "json", SCHEMA, pattern="*.json")
        batches.run_batches(stream, lambda d, i: batches.write_batch(d, out, i), checkpoint).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("file_stream_batches", "SELECT 3::BIGINT AS batches, count(*) AS rows FROM events")
def file_stream_batches(spark, data):
    out, checkpoint = scratch_dir(spark, "streamed"), scratch_dir(spark, "stream-checkpoint")
    stream = files.file_stream(spark, dropped(spark, data), "json", SCHEMA, pattern="*.json", max_files=2)
    batches.run_batches(stream, lambda df, i: batches.write_batch(df, out, i), checkpoint).awaitTermination()
    return spark.read.parquet(out).agg(F.count_distinct("batch_id").alias("batches"), F.count("*").alias("rows"))


@query("archive_done_files", "SELECT event_id, user_id, event_type FROM events")
def archive_done_files(spark, data):
    """Finished files are moved aside; what was read is complete."""
    out, checkpoint, archive = (scratch_dir(spark, n) for n in ("streamed", "stream-checkpoint", "archive"))
    stream = files.file_stream(spark, dropped(spark, data), "json", SCHEMA, pattern="*.json", max_files=3, archive=archive)
    batches.run_batches(stream, lambda df, i: batches.write_batch(df, out, i), checkpoint).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


def mapped_stream(spark, data):
    """Messages as text files, mapped and written batch by batch; returns the result folders."""
    path, out, raw, audit, checkpoint = (
        scratch_dir(spark, n) for n in ("messages", "mapped", "raw", "audit", "stream-checkpoint")
    )
    messages(spark, data).repartition(4).write.text(path)
    stream = mapping.extract_topic(files.file_stream(spark, path, "text", max_files=2), "$.header.category")
    process = batches.mapping_batch(
        DETAILS,
        [lambda df, i: batches.write_batch(df, out, i)],
        audit,
        raw=lambda df, i: batches.write_batch(df, raw, i),
    )
    batches.run_batches(stream, process, checkpoint).awaitTermination()
    return out, raw, audit


@query("micro_batch_map", f"SELECT source || '-' || k || '-one-?' AS row_key, event_type AS topic FROM {MESSAGES}")
def micro_batch_map(spark, data):
    out, _, _ = mapped_stream(spark, data)
    return spark.read.parquet(out).select("row_key", "topic")


@query(
    "micro_batch_last_write",
    f"""SELECT source || '-' || k || '-one-?' AS row_key, max(stamp || '-' || event_type) AS ts,
          arg_max(upper(event_type), (stamp || '-' || event_type, upper(event_type))) AS value FROM {MESSAGES} GROUP BY 1""",
)
def micro_batch_last_write(spark, data):
    """One batch of messages as cells: of several writes to a cell the last one."""
    path, out, checkpoint = (scratch_dir(spark, n) for n in ("messages", "cells", "stream-checkpoint"))
    messages(spark, data).repartition(4).write.text(path)
    stream = mapping.extract_topic(files.file_stream(spark, path, "text", max_files=1000), "$.header.category")
    process = batches.mapping_batch(DETAILS, [lambda df, i: batches.write_batch(df, out, i)], last_write=True)
    batches.run_batches(stream, process, checkpoint).awaitTermination()
    return spark.read.parquet(out).filter("qualifier = 'twice'").select("row_key", "ts", "value")


def numbered(spark, data):
    """Messages with a place in their stream; every seventh has none that is a number, some no topic."""
    place = F.when(F.col("event_id") % 7 == 0, F.lit("none")).otherwise((100000 - F.col("event_id")).cast("string"))
    header = F.struct(
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("category"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source"),
        F.lit("1.0").alias("version"),
        place.alias("place"),
    )
    whole = F.to_json(F.struct(header.alias("header"), F.struct(F.col("event_id").cast("string").alias("id")).alias("data")))
    return table(spark, data, "events").select(F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(whole).alias("value"))


NUMBERED = """(SELECT event_id, 'u' || user_id AS source, CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 5 = 0 THEN 'unknown' ELSE event_type END AS topic,
  event_type = 'error' AS broken, event_id % 7 = 0 AS unplaced FROM events)"""


@query(
    "micro_batch_sorted",
    f"""SELECT 'cell' AS kind, source AS name, arg_max(topic, -event_id) AS topic, max(CAST(event_id AS VARCHAR)) FILTER (event_id = least_id) AS detail, 1::BIGINT AS n
        FROM (SELECT *, min(event_id) OVER (PARTITION BY source) AS least_id FROM {NUMBERED} WHERE NOT broken AND NOT unplaced) GROUP BY source
        UNION ALL SELECT 'reject', CASE WHEN broken THEN 'json' ELSE 'sort' END, topic, NULL, count(*) FROM {NUMBERED} WHERE broken OR unplaced GROUP BY 2, 3
        UNION ALL SELECT 'audit', 'messages', topic, NULL, count(*) FROM {NUMBERED} GROUP BY topic
        UNION ALL SELECT 'audit', 'rows', topic, NULL, count(*) FILTER (NOT broken AND NOT unplaced) FROM {NUMBERED} GROUP BY topic""",
)
def micro_batch_sorted(spark, data):
    """Topics and order from the messages: what the last message in the order says stays."""
    path, out, bad, audit, checkpoint = (scratch_dir(spark, n) for n in ("messages", "cells", "bad", "audit", "stream-checkpoint"))
    numbered(spark, data).repartition(4).write.text(path)
    row = {"name": "sources", "namespace": "shop", "colFamily": "f", "rowKey": ["$.header.source"], "cols": [{"name": "id", "value": "$.data.id"}, {"name": "topic", "value": "topic"}]}
    spec = {"templates": [{"name": "t", "row": row}], "sourceMap": [{"sourceName": "s", "when": "$.header.version == '1.0'", "templates": ["t"], "idockey": ["$.data.id"]}]}
    process = batches.mapping_batch(
        spec,
        [lambda df, i: batches.write_batch(df, out, i)],
        audit,
        last_write=True,
        topic="$.header.category",
        sort_path="$.header.place",
        rejects=lambda df, i: batches.write_batch(df, bad, i),
    )
    batches.run_batches(files.file_stream(spark, path, "text", max_files=1000), process, checkpoint).awaitTermination()
    cells = spark.read.parquet(out).groupBy("row_key").agg(
        F.max(F.when(F.col("qualifier") == "topic", F.col("value"))).alias("topic"), F.max(F.when(F.col("qualifier") == "id", F.col("value"))).alias("detail")
    )
    none = F.lit(None).cast("string")
    told = cells.select(F.lit("cell").alias("kind"), F.col("row_key").alias("name"), "topic", "detail", F.lit(1).cast("bigint").alias("n"))
    rejected = spark.read.parquet(bad).groupBy(F.coalesce("failed", F.lit("json")).alias("name"), "topic").agg(F.count("*").alias("n"))
    counted = spark.read.parquet(audit)
    parts = [rejected.select(F.lit("reject").alias("kind"), "name", "topic", none.alias("detail"), "n")]
    parts += [counted.select(F.lit("audit").alias("kind"), F.lit(c).alias("name"), "topic", none.alias("detail"), F.col(c).alias("n")) for c in ("messages", "rows")]
    return reduce(DataFrame.unionByName, parts, told)


@query("micro_batch_raw", "SELECT CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS topic, count(*) AS messages FROM events GROUP BY 1")
def micro_batch_raw(spark, data):
    _, raw, _ = mapped_stream(spark, data)
    df = spark.read.parquet(raw)
    return df.groupBy(F.coalesce("topic", F.lit("none")).alias("topic")).agg(F.count("*").alias("messages"))


@query(
    "batch_audit",
    """SELECT CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS topic, count(*) AS messages,
         count(*) FILTER (event_type <> 'error') AS rows, count(*) FILTER (event_type <> 'error') AS documents,
         count(*) FILTER (event_type = 'error') AS rejected FROM events GROUP BY 1""",
)
def batch_audit(spark, data):
    """Counts per topic over all batches."""
    _, _, audit = mapped_stream(spark, data)
    df = batches.read_audit(spark, audit)
    sums = [F.sum(c).alias(c) for c in ("messages", "rows", "documents", "rejected")]
    return df.groupBy(F.coalesce("topic", F.lit("none")).alias("topic")).agg(*sums)


HASHED = """SELECT event_id, 'user-' || user_id AS row_key, epoch_us(ts) AS ts, md5(event_type || (json_extract_string(props, '$.k')::INT % 10)) AS dedup_key,
  CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1 WHEN ts < TIMESTAMP '2024-01-20' THEN 2 ELSE 3 END AS slice FROM events"""
LOOK_BACK = 8


def _passing(slice_, before):
    """SQL for the rows of a slice whose hash is not among the last of their key in what passed before."""
    return f"""SELECT * FROM h WHERE slice = {slice_} AND NOT EXISTS (SELECT 1 FROM (SELECT row_key, dedup_key,
      row_number() OVER (PARTITION BY row_key ORDER BY ts DESC, dedup_key DESC) AS rn FROM ({before})) l
      WHERE rn <= {LOOK_BACK} AND l.row_key = h.row_key AND l.dedup_key = h.dedup_key)"""


@query(
    "upsert_stream",
    f"""WITH h AS ({HASHED}), p1 AS (SELECT * FROM h WHERE slice = 1), p2 AS ({_passing(2, 'SELECT * FROM p1')}),
        p3 AS ({_passing(3, 'SELECT * FROM p1 UNION ALL SELECT * FROM p2')})
        SELECT event_id, row_key, ts, dedup_key FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)""",
)
def upsert_stream_slices(spark, data):
    """Events in three slices, the stream started anew for each; its state outlives it."""
    path, out, checkpoint = (scratch_dir(spark, n) for n in ("hashed", "upserts", "stream-checkpoint"))
    rows = table(spark, data, "events").select(
        "event_id",
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("row_key"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        F.md5(F.concat("event_type", (F.get_json_object("props", "$.k").cast("int") % 10).cast("string")).cast("binary")).alias("dedup_key"),
        F.when(F.col("ts") < "2024-01-10", 1).when(F.col("ts") < "2024-01-20", 2).otherwise(3).alias("slice"),
    )
    for part in (1, 2, 3):
        rows.filter(F.col("slice") == part).drop("slice").write.mode("append").json(path)
        stream = files.file_stream(spark, path, "json", "event_id BIGINT, row_key STRING, ts BIGINT, dedup_key STRING", pattern="*.json")
        batches.run_batches(upsert_stream(stream, LOOK_BACK), lambda df, i: batches.write_batch(df, out, i), checkpoint).awaitTermination()
    return spark.read.parquet(out).select("event_id", "row_key", "ts", "dedup_key")


OFFSETS = """(SELECT event_type AS topic, user_id AS partition, event_id AS batch_id, from_offset, from_offset + 10 AS until_offset FROM
  (SELECT *, 10 * row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) + CASE WHEN value > 60 THEN 3 ELSE 0 END AS from_offset FROM events))"""


@query(
    "offset_gaps",
    f"""SELECT topic, partition, batch_id, from_offset, expected FROM (SELECT *, lag(until_offset) OVER
        (PARTITION BY topic, partition ORDER BY batch_id) AS expected FROM {OFFSETS}) WHERE expected <> from_offset""",
)
def offset_gaps(spark, data):
    """An offset log with faults: ranges that do not start where the last one ended."""
    number = F.row_number().over(W.partitionBy("event_type", "user_id").orderBy("event_id"))
    start = 10 * number + F.when(F.col("value") > 60, 3).otherwise(0)
    log = table(spark, data, "events").select(
        F.col("event_type").alias("topic"),
        F.col("user_id").alias("partition"),
        F.col("event_id").alias("batch_id"),
        start.cast("bigint").alias("from_offset"),
    )
    return batches.offset_gaps(log.withColumn("until_offset", F.col("from_offset") + 10))


@query(
    "offset_ranges",
    """SELECT event_type AS topic, user_id AS partition, 7::BIGINT AS batch_id, min(event_id) AS from_offset,
         max(event_id) + 1 AS until_offset FROM events GROUP BY event_type, user_id""",
)
def offset_ranges(spark, data):
    batch = table(spark, data, "events").selectExpr("event_type AS topic", "user_id AS partition", "event_id AS offset")
    return batches.offset_ranges(batch, 7)


@query("batch_doc_ids", f"SELECT DISTINCT event_type AS topic, id AS doc_id FROM {MESSAGES}")
def batch_doc_ids(spark, data):
    """The ids of the documents of all batches."""
    path, out, checkpoint = (scratch_dir(spark, n) for n in ("messages", "doc-ids", "stream-checkpoint"))
    messages(spark, data).repartition(4).write.text(path)
    stream = mapping.extract_topic(files.file_stream(spark, path, "text", max_files=2), "$.header.category")
    process = batches.mapping_batch(DETAILS, [], doc_ids=lambda df, i: batches.write_batch(df, out, i))
    batches.run_batches(stream, process, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("topic", "doc_id")


@query(
    "pending_runs",
    """SELECT DISTINCT l_orderkey AS run FROM lineitem WHERE l_linestatus = 'F' AND l_orderkey NOT IN
       (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def pending_runs(spark, data):
    df = table(spark, data, "lineitem").withColumnRenamed("l_orderkey", "run")
    finished = df.filter("l_linestatus = 'F'").select("run").distinct()
    return batches.pending_runs(finished, df.filter("l_returnflag = 'R'"), ["run"])
