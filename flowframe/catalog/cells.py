"""Queries of the cell log."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import cells as op
from flowframe.session import scratch_dir
from flowframe.sources import sinks

TYPES = ["click", "purchase", "view"]
MID, END = 1705276800000000, 1705881600000000  # 2024-01-15 and 2024-01-22 in microseconds


def log(spark, data):
    """Events as cells: a row per user, a qualifier per event type."""
    return table(spark, data, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("row_key"),
        F.lit("f").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("event_id").cast("string").alias("value"),
    )


LOG = """(SELECT 'user-' || user_id AS row_key, 'f' AS family, event_type AS qualifier, epoch_us(ts) AS ts,
  CAST(event_id AS VARCHAR) AS value FROM events)"""
PIVOT = ", ".join(f"arg_max(value, ts) FILTER (qualifier = '{t}') AS \"{t}\"" for t in TYPES)
WANTED = "qualifier IN ('click', 'purchase', 'view')"


@query("cells_latest", f"SELECT row_key, {PIVOT} FROM {LOG} WHERE {WANTED} GROUP BY row_key")
def cells_latest(spark, data):
    return op.cells_latest(log(spark, data), TYPES, "f")


@query("read_cells_latest", f"SELECT row_key, {PIVOT} FROM {LOG} WHERE {WANTED} GROUP BY row_key")
def read_cells_latest(spark, data):
    """The log stored as files by family and read back; only the wanted qualifiers are scanned."""
    path = scratch_dir(spark, "cells")
    sinks.write_files(log(spark, data), path, partition_cols=["family"])
    return op.cells_latest(spark.read.parquet(path), TYPES, "f")


@query(
    "cells_versions",
    f"""SELECT row_key, ts, {PIVOT} FROM (SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY ts DESC) AS rn
        FROM {LOG} WHERE {WANTED}) WHERE rn <= 3 GROUP BY row_key, ts""",
)
def cells_versions(spark, data):
    return op.cells_versions(log(spark, data), TYPES, 3)


@query(
    "read_cells_versions",
    f"""SELECT row_key, ts, {PIVOT} FROM (SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY ts DESC) AS rn
        FROM {LOG} WHERE {WANTED}) WHERE rn <= 100 AND ts > {MID} GROUP BY row_key, ts""",
)
def read_cells_versions(spark, data):
    """Up to a hundred versions, then only recent ones."""
    return op.cells_versions(log(spark, data), TYPES, 100).filter(F.col("ts") > MID)


@query("cells_as_of", f"SELECT * FROM {LOG} WHERE ts = (SELECT max(ts) FROM {LOG})")
def cells_as_of(spark, data):
    df = log(spark, data)
    newest = df.agg(F.max("ts")).first()[0]  # one value
    return op.cells_in(df, at=newest)


@query("cells_between", f"SELECT * FROM {LOG} WHERE ts >= {MID} AND ts < {END}")
def cells_between(spark, data):
    return op.cells_in(log(spark, data), low=MID, high=END)


@query("read_cells_time_range", f"SELECT row_key, {PIVOT} FROM {LOG} WHERE {WANTED} AND ts >= {MID} AND ts < {END} GROUP BY row_key")
def read_cells_time_range(spark, data):
    return op.cells_latest(op.cells_between(log(spark, data), MID, END), TYPES)


@query(
    "cells_dynamic_map",
    f"""SELECT row_key, CAST(to_json(map_from_entries(list({{'k': qualifier, 'v': value}} ORDER BY qualifier))) AS VARCHAR) AS cells
        FROM (SELECT row_key, qualifier, arg_max(value, ts) AS value FROM {LOG} GROUP BY ALL) GROUP BY row_key""",
)
def cells_dynamic_map(spark, data):
    return op.cells_dynamic_map(log(spark, data), "f").withColumn("cells", F.to_json("cells"))


@query("cells_dynamic_versions", f"SELECT row_key, qualifier, ts, value FROM {LOG}")
def cells_dynamic_versions(spark, data):
    """A map of version maps per row, flattened again."""
    df = op.cells_dynamic_map(log(spark, data), "f", versions=True)
    wide = df.select("row_key", F.explode("cells").alias("qualifier", "versions"))
    return wide.select("row_key", "qualifier", F.explode("versions").alias("ts", "value"))


@query("cells_dynamic_parts", f"SELECT row_key, qualifier, ts, value, true AS bounded FROM {LOG}")
def cells_dynamic_parts(spark, data):
    """Version maps cut into parts that together hold every cell."""
    df = op.cells_dynamic_map(log(spark, data), "f", versions=True, max_cells=8)
    size = F.aggregate(F.map_values("cells"), F.lit(0), lambda a, m: a + F.size(m))
    wide = df.select("row_key", (size < 64).alias("bounded"), F.explode("cells").alias("qualifier", "versions"))
    return wide.select("row_key", "qualifier", F.explode("versions").alias("ts", "value"), "bounded")


@query(
    "cells_from_frame",
    """SELECT CAST(p_partkey AS VARCHAR) AS row_key, family, qualifier, 1::BIGINT AS ts, value FROM (
         SELECT p_partkey, 'a' AS family, 'p_name' AS qualifier, p_name AS value FROM part
         UNION ALL SELECT p_partkey, 'a', 'brand', nullif(p_brand, 'Brand#2') FROM part
         UNION ALL SELECT p_partkey, 'b', 'size', CAST(p_size AS VARCHAR) FROM part
         UNION ALL SELECT p_partkey, 'b', 'type', p_type FROM part) WHERE value IS NOT NULL
       UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'c', 'type', CAST(p_size AS BIGINT), p_type FROM part""",
)
def cells_from_frame(spark, data):
    """Nulls write no cell; map columns expand to qualifiers, or to qualifiers and versions."""
    df = table(spark, data, "part").select(
        "p_partkey",
        "p_name",
        F.nullif(F.col("p_brand"), F.lit("Brand#2")).alias("brand"),
        F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("type"), F.col("p_type")).alias("more"),
        F.create_map(F.lit("type"), F.create_map(F.col("p_size").cast("bigint"), F.col("p_type"))).alias("versions"),
    )
    key, ts = F.col("p_partkey").cast("string"), F.lit(1).cast("bigint")
    return op.cells_from_frame(df, key, ts, {"p_name": "a", "brand": "a", "more": "b", "versions": "c"})


HASHES = "(SELECT row_key, ts, md5(qualifier || k) AS dedup_key FROM (SELECT 'user-' || user_id AS row_key, epoch_us(ts) AS ts, event_type AS qualifier, json_extract_string(props, '$.k') AS k FROM events))"


@query(
    "upsert_with_lookback",
    f"""WITH h AS (SELECT * FROM {HASHES}),
        last AS (SELECT row_key, dedup_key FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY ts DESC, dedup_key DESC) AS rn
          FROM h WHERE ts < {END}) WHERE rn <= 50)
        SELECT row_key, ts, dedup_key FROM h WHERE ts >= {END} AND NOT EXISTS
          (SELECT 1 FROM last WHERE last.row_key = h.row_key AND last.dedup_key = h.dedup_key)""",
)
def upsert_with_lookback(spark, data):
    df = table(spark, data, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("row_key"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        F.md5(F.concat("event_type", F.get_json_object("props", "$.k"))).alias("dedup_key"),
    )
    return op.upsert_with_lookback(df.filter(F.col("ts") < END), df.filter(F.col("ts") >= END), 50)


@query(
    "batch_last_write_wins",
    f"SELECT row_key, family, qualifier, max(ts) AS ts, arg_max(value, ts) AS value FROM {LOG} GROUP BY row_key, family, qualifier",
)
def batch_last_write_wins(spark, data):
    return op.batch_last_write_wins(log(spark, data), ["row_key", "family", "qualifier"], "ts")


@query("latest_first_key", "SELECT user_id, max(ts)::VARCHAR AS ts, arg_max(event_id, ts) AS event_id FROM events GROUP BY user_id")
def latest_first_key(spark, data):
    df = op.latest_versions(table(spark, data, "events"), "user_id", "ts", "event_id")
    return df.withColumn("ts", F.col("ts").cast("string"))
