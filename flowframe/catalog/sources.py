"""Queries of readers. Files are written from the given tables first, then read back."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators.columns import safe_column_names
from flowframe.session import scratch_dir
from flowframe.sources import external, files, sinks


@query("read_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_csv(spark, data):
    path = scratch_dir(spark, "csv")
    sinks.write_files(table(spark, data, "customer"), path, "CSV")
    df = files.read_files(spark, path, "CSV", {"header": "true"})
    return df.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("read_csv_delimiter", "SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name FROM supplier")
def read_csv_delimiter(spark, data):
    path = scratch_dir(spark, "csv")
    df = table(spark, data, "supplier").select("s_suppkey", "s_name")
    sinks.write_files(df, path, "csv", options={"header": "false", "sep": "|"})
    read = files.read_files(spark, path, "csv", {"sep": "|"})
    return read.select(F.col("_c0").cast("bigint").alias("id"), F.col("_c1").alias("name"))


@query("read_json", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def read_json(spark, data):
    path = scratch_dir(spark, "json")
    sinks.write_files(table(spark, data, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), path, "json")
    return files.read_files(spark, path, "JSON")


@query("read_parquet", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_size > 10")
def read_parquet(spark, data):
    df = files.read_files(spark, f"{data}/part.parquet", "PARQUET", where="p_size > 10")
    return df.select("p_partkey", "p_name", "p_brand")


@query("read_orc", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def read_orc(spark, data):
    path = scratch_dir(spark, "orc")
    sinks.write_files(table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), path, "ORC")
    return files.read_files(spark, path, "ORC")


@query("read_text", "SELECT p_name AS value FROM part")
def read_text(spark, data):
    path = scratch_dir(spark, "text")
    sinks.write_files(table(spark, data, "part").select(F.col("p_name").alias("value")), path, "text")
    return files.read_files(spark, path)


@query("read_any", "SELECT count(*) AS files, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END)::BIGINT AS filled FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)")
def read_any(spark, data):
    """A format without a reader of its own: file contents as they are."""
    path = scratch_dir(spark, "any")
    df = table(spark, data, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string"))
    df.repartition("o_orderstatus").write.partitionBy("o_orderstatus").text(path)
    found = files.read_files(spark, path, "binaryFile", {"recursiveFileLookup": "true", "pathGlobFilter": "*.txt"})
    return found.agg(F.count("*").alias("files"), F.count_if(F.col("length") > 0).alias("filled"))


@query("reader_project_filter", "SELECT l_orderkey AS order_id, l_quantity AS qty FROM lineitem WHERE l_quantity >= 45")
def reader_project_filter(spark, data):
    return files.read_files(
        spark,
        f"{data}/lineitem.parquet",
        "parquet",
        project=[("l_orderkey", "order_id"), ("l_quantity", "qty")],
        where="qty >= 45",
    )


@query(
    "read_month_partitions",
    """SELECT customer, priority, min(ordered) AS ordered FROM (SELECT o_custkey AS customer, o_orderpriority AS priority,
         strftime(o_orderdate, '%Y%m%d%H%M%S') AS ordered, strftime(o_orderdate, '%Y%m') AS m FROM orders)
       WHERE m BETWEEN '199703' AND '199806' AND (m < '199806' OR ordered <= '19980615') AND priority <> '5-LOW'
       GROUP BY customer, priority""",
)
def read_month_partitions(spark, data):
    path = scratch_dir(spark, "months")
    df = table(spark, data, "orders").select(
        "o_custkey",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("stamp"),
        F.date_format("o_orderdate", "yyyyMM").alias("yearmonth"),
    )
    sinks.write_files(df, path, "parquet", partition_cols=["yearmonth"])
    return files.read_month_partitions(
        spark,
        path,
        {"o_custkey": "customer", "o_orderpriority": "priority"},
        ("stamp", "ordered"),
        "priority <> '5-LOW'",
        "199703",
        "19980615",
    )


@query("read_with_declared_cols", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def read_with_declared_cols(spark, data):
    path = scratch_dir(spark, "declared")
    sinks.write_files(table(spark, data, "nation"), path, "csv", options={"header": "false"})
    return files.read_files(spark, path, "csv", schema=files.declared("id, name, region"))


@query(
    "rows_as_json",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"' || CASE WHEN c_mktsegment = 'BUILDING' THEN ''
       ELSE ',"segment":"' || c_mktsegment || '"' END || '}' AS value FROM customer""",
)
def rows_as_json(spark, data):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    return files.rows_as_json(table(spark, data, "customer").select("c_custkey", "c_name", segment))


@query(
    "read_event_bus_bodies",
    """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def read_event_bus_bodies(spark, data):
    """Bodies as a bus delivers them; their common schema is found by one aggregation."""
    df = table(spark, data, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )
    return external.parse_bodies(sinks.bus_frame(df)).select("event_id", "event_type", "k")


@query("schema_evolution_read", "SELECT p_partkey, p_name, '' AS p_brand, NULL::INTEGER AS p_size FROM part")
def schema_evolution_read(spark, data):
    """Old files lack columns that the saved schema has by now."""
    old, new = scratch_dir(spark, "old"), scratch_dir(spark, "new")
    parts = table(spark, data, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    sinks.write_files(parts.select("p_partkey", "p_name"), old)
    sinks.write_with_schema(parts, new)
    return sinks.schema_evolution_read(spark, old, f"{new}.schema")


@query("read_renamed_safe", "SELECT r_regionkey AS region_key, r_name AS region_name FROM region")
def read_renamed_safe(spark, data):
    """Header names with blanks become safe column names."""
    path = scratch_dir(spark, "safe")
    sinks.write_files(table(spark, data, "region").toDF("region key", "region name"), path, "csv")
    return safe_column_names(files.read_files(spark, path, "csv", {"header": "true"}))
