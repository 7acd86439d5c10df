"""Queries of joins, set operators, branches and ordering."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import relational as op


def customers(spark, data):
    return table(spark, data, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey")


def orders(spark, data):
    return table(spark, data, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderstatus")


def spaced_customers(spark, data):
    """All customers under twice their key, so that either side has rows without a partner."""
    df = table(spark, data, "customer")
    return df.select((F.col("c_custkey") * 2).alias("custkey"), "c_name", "c_nationkey")


SPACED = "(SELECT c_custkey * 2 AS custkey, c_name, c_nationkey FROM customer) c"
ORDERS = "(SELECT o_custkey AS custkey, o_orderkey, o_orderstatus FROM orders) o"


def _join(how):
    def run(spark, data):
        return op.join(spaced_customers(spark, data), orders(spark, data), ["custkey"], how)

    return run


for _how, _sql in {
    "inner": f"SELECT custkey, c_name, c_nationkey, o_orderkey, o_orderstatus FROM {SPACED} JOIN {ORDERS} USING (custkey)",
    "left": f"SELECT custkey, c_name, c_nationkey, o_orderkey, o_orderstatus FROM {SPACED} LEFT JOIN {ORDERS} USING (custkey)",
    "right": f"SELECT o.custkey, c_name, c_nationkey, o_orderkey, o_orderstatus FROM {SPACED} RIGHT JOIN {ORDERS} ON c.custkey = o.custkey",
    "outer": f"SELECT coalesce(c.custkey, o.custkey) AS custkey, c_name, c_nationkey, o_orderkey, o_orderstatus FROM {SPACED} FULL JOIN {ORDERS} ON c.custkey = o.custkey",
    "semi": f"SELECT custkey, c_name, c_nationkey FROM {SPACED} WHERE custkey IN (SELECT custkey FROM {ORDERS})",
    "anti": f"SELECT custkey, c_name, c_nationkey FROM {SPACED} WHERE custkey NOT IN (SELECT custkey FROM {ORDERS})",
}.items():
    query(f"join_{_how}", _sql)(_join(_how))


@query(
    "join_diff_names",
    "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2",
)
def join_diff_names(spark, data):
    nation = table(spark, data, "nation").filter("n_regionkey <> 2")
    df = op.join_on(table(spark, data, "customer"), nation, [("c_nationkey", "n_nationkey")])
    return df.select("c_custkey", "c_name", "n_name")


@query(
    "join_null_safe_anti",
    """WITH a AS (SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS priority, CAST(o_orderdate AS VARCHAR) AS ts,
         o_orderstatus FROM orders),
       b AS (SELECT DISTINCT o_custkey, priority FROM a WHERE o_orderstatus = 'F')
       SELECT o_custkey, priority, ts FROM a WHERE NOT EXISTS (SELECT 1 FROM b
         WHERE b.o_custkey = a.o_custkey AND b.priority IS NOT DISTINCT FROM a.priority)""",
)
def join_null_safe_anti(spark, data):
    df = table(spark, data, "orders").select(
        "o_custkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.col("o_orderdate").cast("string").alias("ts"),
        "o_orderstatus",
    )
    done = df.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    return op.anti_join_null_safe(df.drop("o_orderstatus"), done, ignore=["ts"])


@query(
    "join_multi_way",
    """SELECT l_orderkey, l_linenumber, c_name, CAST(greatest(o_orderdate, l_shipdate) AS VARCHAR) AS serial
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def join_multi_way(spark, data):
    lines = table(spark, data, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_orderkey", "l_linenumber", "l_shipdate"
    )
    heads = table(spark, data, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), "o_orderdate"
    )
    df = op.join_all(lines, [(heads, ["orderkey"]), (customers(spark, data), ["custkey"])])
    serial = F.greatest("o_orderdate", "l_shipdate").cast("string").alias("serial")
    return df.select("l_orderkey", "l_linenumber", "c_name", serial)


@query(
    "role_pivot",
    """SELECT user_id, arg_max(value, ts) FILTER (event_type = 'click') AS click_value,
         arg_max(value, ts) FILTER (event_type = 'view') AS view_value,
         CAST(max(ts) FILTER (event_type = 'click') AS VARCHAR) AS click_timestamp,
         CAST(max(ts) FILTER (event_type = 'view') AS VARCHAR) AS view_timestamp,
         CAST(max(ts) AS VARCHAR) AS serial
       FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id""",
)
def role_pivot(spark, data):
    names = {"click": {"value": "click_value"}, "view": {"value": "view_value"}}
    df = op.role_pivot(table(spark, data, "events"), ["user_id"], "event_type", names, "ts")
    stamps = {c: F.col(c).cast("string") for c in ("click_timestamp", "view_timestamp", "serial")}
    return df.withColumns(stamps)


@query(
    "union",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union(spark, data):
    left = table(spark, data, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return op.union(left, table(spark, data, "supplier").select("s_suppkey", "s_name"))


@query(
    "union_ragged",
    """SELECT c_mktsegment AS segment, c_custkey AS id, c_name AS name, NULL::INTEGER AS nation FROM customer
       UNION ALL SELECT NULL, s_suppkey, s_name, s_nationkey FROM supplier""",
)
def union_ragged(spark, data):
    left = table(spark, data, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    right = table(spark, data, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS id", "s_name AS name")
    return op.union_ragged(left, right)


@query(
    "except_distinct",
    "SELECT l_partkey, l_suppkey FROM lineitem EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'",
)
def except_distinct(spark, data):
    df = table(spark, data, "lineitem")
    return op.except_distinct(
        df.select("l_partkey", "l_suppkey"), df.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey")
    )


@query("distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct(spark, data):
    return op.distinct(table(spark, data, "lineitem").select("l_orderkey", "l_linenumber"))


@query("drop_duplicates", "SELECT DISTINCT o_custkey FROM orders")
def drop_duplicates(spark, data):
    return op.distinct(table(spark, data, "orders"), ["o_custkey"]).select("o_custkey")


@query(
    "tee",
    """SELECT 'all' AS branch, count(*) AS n FROM orders UNION ALL
       SELECT 'finished', count(*) FROM orders WHERE o_orderstatus = 'F'""",
)
def tee(spark, data):
    first, second = op.tee(table(spark, data, "orders"))
    count = F.count("*").alias("n")
    whole = first.agg(count).select(F.lit("all").alias("branch"), "n")
    return whole.unionByName(second.filter("o_orderstatus = 'F'").agg(count).select(F.lit("finished").alias("branch"), "n"))


MAYBE = "SELECT l_orderkey, l_suppkey, nullif(l_returnflag, 'N') AS flag FROM lineitem"


def _flags(spark, data):
    return table(spark, data, "lineitem").selectExpr("l_orderkey", "l_suppkey", "nullif(l_returnflag, 'N') AS flag")


@query("split_true", f"SELECT * FROM ({MAYBE}) WHERE flag = 'R'")
def split_true(spark, data):
    return op.split(_flags(spark, data), "flag = 'R'")[0]


@query("split_false", f"SELECT * FROM ({MAYBE}) WHERE NOT coalesce(flag = 'R', false)")
def split_false(spark, data):
    return op.split(_flags(spark, data), "flag = 'R'")[1]


@query("split_false_distinct", f"SELECT * FROM ({MAYBE}) EXCEPT SELECT * FROM ({MAYBE}) WHERE flag = 'R'")
def split_false_distinct(spark, data):
    return op.split(_flags(spark, data), "flag = 'R'", distinct=True)[1]


@query("sort", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC")
def sort(spark, data):
    df = table(spark, data, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return op.sort(df, ["o_orderpriority", "o_totalprice desc"])


@query(
    "sort_by_json_field",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS sort_key FROM events
       WHERE event_type <> 'error'""",
)
def sort_by_json_field(spark, data):
    broken = F.when(F.col("event_type") == "error", F.lit("{not json")).otherwise(F.col("props"))
    df = table(spark, data, "events").select("event_id", broken.alias("value"))
    return op.sort_by_json_field(df, "value", "$.k").drop("value")


@query("limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit(spark, data):
    df = table(spark, data, "orders").select("o_orderkey", "o_totalprice")
    return op.limit(op.sort(df, ["o_totalprice desc", "o_orderkey"]), 100)


@query("partition_sort", "SELECT user_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events")
def partition_sort(spark, data):
    df = op.partition_sort(table(spark, data, "events").select("user_id", "event_type", "ts"), ["user_id"], ["ts"])
    return df.withColumn("ts", F.col("ts").cast("string"))


@query("partition_sort_together", "SELECT user_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events")
def partition_sort_together(spark, data):
    df = table(spark, data, "events").select("user_id", "event_type", "ts")
    return op.partition_sort(df, ["user_id"], ["ts"], split_hot=False).withColumn("ts", F.col("ts").cast("string"))
