"""Queries of writers: the prepared frame, or what is read back after the write."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import cells, mapping
from flowframe.session import scratch_dir
from flowframe.sources import sinks


def mapped(spark, data):
    """Mapped rows from events: a table per event type, a row per user."""
    return table(spark, data, "events").select(
        F.concat(F.lit("t_"), "event_type").alias("table_name"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("row_key"),
        F.lit("f").alias("family"),
        F.create_map(
            F.lit("event"),
            F.col("event_id").cast("string"),
            F.lit("partYYYY"),
            F.date_format("ts", "yyyy"),
            F.lit("partMM"),
            F.date_format("ts", "MM"),
            F.lit("partDD"),
            F.date_format("ts", "dd"),
        ).alias("cells"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("sort_key"),
    )


def _round_trip(fmt):
    def run(spark, data):
        path = scratch_dir(spark, f"write-{fmt}")
        df = table(spark, data, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
        sinks.write_files(df, path, fmt)
        sinks.write_files(df.filter("o_orderstatus = 'P'"), path, fmt, mode="append")
        read = spark.read.format(fmt).option("header", "true").load(path)
        return read.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))

    return run


for _fmt in ("csv", "json", "parquet", "orc"):
    query(
        f"write_files_{_fmt}",
        """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders UNION ALL
           SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""",
    )(_round_trip(_fmt))


@query("write_files_partitioned", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def write_files_partitioned(spark, data):
    path = scratch_dir(spark, "write-partitioned")
    df = table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    sinks.write_files(df, path, "parquet", codec="zstd", partition_cols=["l_returnflag"])
    return spark.read.parquet(path)


@query("write_files_ignore", "SELECT r_regionkey, r_name FROM region")
def write_files_ignore(spark, data):
    """An existing target is left as it is."""
    path = scratch_dir(spark, "write-ignore")
    sinks.write_files(table(spark, data, "region"), path, "json")
    sinks.write_files(table(spark, data, "nation"), path, "json", mode="ignore")
    read = spark.read.json(path)
    return read.withColumn("r_regionkey", F.col("r_regionkey").cast("int"))


@query(
    "jdbc_frame",
    """SELECT DISTINCT l_orderkey || '_' || l_linenumber AS df_key, l_orderkey, l_linenumber,
         CAST(to_json({'part': l_partkey, 'supp': l_suppkey}) AS VARCHAR) AS ids FROM lineitem""",
)
def jdbc_frame(spark, data):
    ids = F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")).alias("ids")
    df = table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", ids)
    return sinks.jdbc_frame(df, ["l_orderkey", "l_linenumber"])


@query(
    "jdbc_content",
    """SELECT DISTINCT coalesce(nullif(o_orderpriority, '5-LOW'), '') ||
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '_' END || o_custkey AS df_key,
         '{' || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '"priority":"' || o_orderpriority || '",' END ||
         '"o_custkey":' || o_custkey || ',"flowName":"orders"}' AS content FROM orders""",
)
def jdbc_content(spark, data):
    """A null first key part leaves no separator behind."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    df = table(spark, data, "orders").select(priority, "o_custkey")
    return sinks.jdbc_frame(df, ["priority", "o_custkey"], flow="orders")


@query("write_event_bus", """SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' AS body FROM supplier""")
def write_event_bus(spark, data):
    return sinks.bus_frame(table(spark, data, "supplier").select("s_suppkey", "s_name"))


SUPPLIER_MAP = {
    "version": "0.4.1",
    "templates": [
        {
            "name": "supplier",
            "row": {
                "name": "suppliers",
                "namespace": "shop",
                "colFamily": "f",
                "rowKey": ["id"],
                "cols": [
                    {"name": "id", "value": "$.data.s_suppkey", "isDedup": True},
                    {"name": "name", "value": "$.data.s_name"},
                    {"name": "note", "value": "$.data.note"},
                ],
            },
        }
    ],
    "sourceMap": [
        {"sourceName": "suppliers", "templates": ["supplier"], "when": "topic == 'supplier'", "idockey": ["$.data.s_suppkey"], "sortkey": ["$.data.s_suppkey"]}
    ],
}


@query(
    "write_cells",
    """SELECT CAST(s_suppkey AS VARCHAR) AS row_key, 'f' AS family, unnest(['id', 'name']) AS qualifier,
         unnest([CAST(s_suppkey AS VARCHAR), s_name]) AS value FROM supplier""",
)
def write_cells(spark, data):
    """Rows become documents without empty fields, documents mapped rows, mapped rows cells."""
    df = table(spark, data, "supplier").select("s_suppkey", "s_name", F.lit("").alias("note"))
    documents = sinks.document_frame(df).withColumn("topic", F.lit("supplier"))
    rows = mapping.map_documents(documents, SUPPLIER_MAP).rows
    return cells.mapped_cells(rows).select("row_key", "family", "qualifier", "value")


@query(
    "store_raw",
    """SELECT event_type AS topic, strftime(ts, '%Y%m') AS yearmonth, strftime(ts, '%d') || '005959' AS daytimestamp,
         props AS value FROM events""",
)
def store_raw(spark, data):
    """Messages arrive in one drop per day and topic."""
    path = scratch_dir(spark, "raw")
    arrived = table(spark, data, "events").withColumn("arrived", F.date_trunc("day", "ts"))
    sinks.store_raw(arrived, path, "event_type", "props", "arrived")
    schema = "value string, topic string, yearmonth string, daytimestamp string"
    return spark.read.schema(schema).parquet(path)


@query(
    "store_mapped",
    """SELECT 't_' || event_type AS table_name, 'user-' || user_id AS row_key, CAST(event_id AS VARCHAR) AS event,
         strftime(ts, '%Y') AS y, strftime(ts, '%m') AS m, strftime(ts, '%d') AS d FROM events""",
)
def store_mapped(spark, data):
    path = scratch_dir(spark, "mapped")
    sinks.store_mapped(mapped(spark, data), path)
    schema = "table_name string, row_key string, cells map<string,string>, y string, m string, d string"
    return spark.read.schema(schema).parquet(path).selectExpr("table_name", "row_key", "cells['event'] AS event", "y", "m", "d")


@query(
    "write_mapped_jdbc",
    """SELECT 't_' || event_type AS table_name, 'user-' || user_id AS row_key,
         '{"event":"' || event_id || '","partYYYY":"' || strftime(ts, '%Y') || '","partMM":"' || strftime(ts, '%m')
         || '","partDD":"' || strftime(ts, '%d') || '"}' AS cells FROM events""",
)
def write_mapped_jdbc(spark, data):
    return sinks.mapped_jdbc_frame(mapped(spark, data)).select("table_name", "row_key", "cells")


@query(
    "write_mapped_bus",
    """SELECT CASE event_type WHEN 'click' THEN 'hot' WHEN 'view' THEN 'hot' ELSE 'rest' END AS topic,
         '{"table_name":"t_' || event_type || '","row_key":"user-' || user_id || '"}' AS value FROM events""",
)
def write_mapped_bus(spark, data):
    rows = mapped(spark, data).select("table_name", "row_key")
    return sinks.mapped_bus_frame(rows, {"t_click": "hot", "t_view": "hot"}, "rest")


@query("multi_sink", "SELECT 'a' AS sink, o_orderkey FROM orders UNION ALL SELECT 'b', o_orderkey FROM orders")
def multi_sink(spark, data):
    first, second = scratch_dir(spark, "sink-a"), scratch_dir(spark, "sink-b")
    df = table(spark, data, "orders").select("o_orderkey")
    sinks.multi_sink(df, [lambda d: sinks.write_files(d, first), lambda d: sinks.write_files(d, second, "orc")])
    a = spark.read.parquet(first).select(F.lit("a").alias("sink"), "o_orderkey")
    return a.unionByName(spark.read.orc(second).select(F.lit("b").alias("sink"), "o_orderkey"))


@query("per_table_counts", "SELECT 't_' || event_type AS table_name, count(*) AS rows FROM events GROUP BY event_type")
def per_table_counts(spark, data):
    return sinks.per_table_counts(mapped(spark, data))


@query(
    "write_counted",
    """SELECT 't_' || event_type AS table_name, count(*) AS rows FROM events WHERE event_type <> 'error' GROUP BY 1
       UNION ALL SELECT NULL, count(*) FILTER (event_type = 'error') FROM events""",
)
def write_counted(spark, data):
    """Rows per table, counted while they are written; a table that wasn't named counts among the others."""
    path = scratch_dir(spark, "counted")
    names = [r[0] for r in table(spark, data, "events").select("event_type").distinct().collect()]
    counts = sinks.write_counted(mapped(spark, data), [f"t_{n}" for n in names if n != "error"], lambda df: df.write.parquet(path))
    assert spark.read.parquet(path).count() == sum(counts.values())
    return spark.createDataFrame(list(counts.items()), "table_name string, rows long")


@query("compact_files", "SELECT event_id, event_type FROM events")
def compact_files(spark, data):
    source, target = scratch_dir(spark, "small"), scratch_dir(spark, "compact")
    table(spark, data, "events").select("event_id", "event_type").repartition(40).write.parquet(source)
    sinks.compact_files(spark, source, target, file_bytes=1 << 20)
    return spark.read.parquet(target)
