"""Queries of the column operators."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import columns as op
from flowframe.operators.nesting import push_struct_array as nest


@query(
    "filter",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30",
)
def filter_rows(spark, data):
    df = op.filter_rows(table(spark, data, "lineitem"), "l_returnflag = 'R' AND l_quantity > 30")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("filter_empty", "SELECT c_custkey, c_name FROM customer")
def filter_empty(spark, data):
    return op.filter_rows(table(spark, data, "customer").select("c_custkey", "c_name"), "")


@query("select", "SELECT o_orderkey, o_orderstatus FROM orders")
def select(spark, data):
    return op.select_cols(table(spark, data, "orders"), ["o_orderkey", "o_orderstatus"])


@query("project", "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders")
def project(spark, data):
    return op.project(table(spark, data, "orders"), [("o_orderkey", "order_id"), ("o_custkey", "customer_id")])


@query("drop_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_columns(spark, data):
    return op.drop_columns(table(spark, data, "supplier"), ["s_nationkey", "s_acctbal", "no_such_column"])


@query("with_column", "SELECT c_custkey, concat_ws('-', c_name, c_mktsegment) AS label FROM customer")
def with_column(spark, data):
    return op.with_column(table(spark, data, "customer"), "label", "concat_ws('-', c_name, c_mktsegment)").select(
        "c_custkey", "label"
    )


@query(
    "with_columns",
    """SELECT l_orderkey, l_linenumber + 100 AS l_linenumber, l_linenumber * 2 AS twice,
       l_linenumber * 2 + 1 AS twice_one, l_linenumber + 101 AS after FROM lineitem""",
)
def with_columns(spark, data):
    df = table(spark, data, "lineitem").select("l_orderkey", "l_linenumber")
    return op.with_columns(
        df,
        [
            ("twice", "l_linenumber * 2"),
            ("twice_one", "twice + 1"),
            ("l_linenumber", "l_linenumber + 100"),
            ("after", "l_linenumber + 1"),
        ],
    )


@query("rename_column", "SELECT n_nationkey AS nation_id, n_name, n_regionkey FROM nation")
def rename_column(spark, data):
    df = op.rename_column(table(spark, data, "nation"), "n_nationkey", "nation_id")
    return op.rename_column(df, "no_such_column", "x")


@query(
    "push_struct",
    """SELECT s_suppkey, CAST(to_json({'s_name': s_name, 's_nationkey': s_nationkey}) AS VARCHAR) AS info
       FROM supplier""",
)
def push_struct(spark, data):
    df = table(spark, data, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return op.push_struct(df, "info", ["s_name", "s_nationkey"]).withColumn("info", F.to_json("info"))


@query(
    "push_struct_array",
    """SELECT o_custkey, CAST(to_json(list({'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority}
       ORDER BY o_orderkey, o_orderpriority)) AS VARCHAR) AS orders FROM orders GROUP BY o_custkey""",
)
def push_struct_array(spark, data):
    df = table(spark, data, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return nest(df, "orders", ["o_orderkey", "o_orderpriority"]).withColumn("orders", F.to_json("orders"))


@query(
    "push_struct_array_parts",
    "SELECT l_returnflag, l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS shipped FROM lineitem",
)
def push_struct_array_parts(spark, data):
    """Few, large groups: their arrays are cut into parts, and together hold every row."""
    df = table(spark, data, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("shipped")
    )
    nested = nest(df, "rows", ["l_orderkey", "l_linenumber", "shipped"], max_items=1000)
    return nested.select("l_returnflag", F.inline("rows"))


@query("pop_struct", "SELECT s_name, s_nationkey FROM supplier")
def pop_struct(spark, data):
    df = op.push_struct(table(spark, data, "supplier"), "info", ["s_name", "s_nationkey"])
    return op.pop_struct(df, "info")


@query("pop_struct_keep_rest", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def pop_struct_keep_rest(spark, data):
    df = table(spark, data, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return op.pop_struct(op.push_struct(df, "info", ["s_name", "s_nationkey"]), "info", keep_rest=True)


@query("explode_array", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_array(spark, data):
    df = table(spark, data, "part").select("p_partkey", F.split("p_name", " ").alias("word"))
    return op.explode_array(df, "word")


@query(
    "explode_array_outer",
    """SELECT p_partkey, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
       WHERE p_brand <> 'Brand#2' UNION ALL SELECT p_partkey, NULL FROM part WHERE p_brand = 'Brand#2')""",
)
def explode_array_outer(spark, data):
    words = F.when(F.col("p_brand") != "Brand#2", F.split("p_name", " "))
    return op.explode_array(table(spark, data, "part").select("p_partkey", words.alias("word")), "word", outer=True)


@query("explode_pop", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def explode_pop(spark, data):
    df = table(spark, data, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    nested = nest(df, "by_status", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return op.explode_pop(nested, "by_status")


@query(
    "drop_null_fields_json",
    """SELECT '{"data":{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"'
       || CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END
       || '}}' AS value FROM customer""",
)
def drop_null_fields_json(spark, data):
    segment = F.expr(
        "CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS segment"
    )
    return op.compact_json(table(spark, data, "customer").select("c_custkey", "c_name", segment))


@query("safe_column_names", "SELECT r_regionkey AS region_key_, r_name AS the_name FROM region")
def safe_column_names(spark, data):
    return op.safe_column_names(table(spark, data, "region").toDF("region.key#", " the name "))


@query("key_prefix_filter", "SELECT c_custkey, c_name FROM customer WHERE starts_with(c_name, 'Customer#00000001')")
def key_prefix_filter(spark, data):
    return op.key_prefix_filter(table(spark, data, "customer").select("c_custkey", "c_name"), "c_name", "Customer#00000001")


@query("key_suffix_filter", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%7'")
def key_suffix_filter(spark, data):
    return op.key_suffix_filter(table(spark, data, "customer").select("c_custkey", "c_name"), "c_name", "7")


@query("key_contains", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def key_contains(spark, data):
    return op.key_contains(table(spark, data, "part").select("p_partkey", "p_name"), "p_name", "ring")


@query("key_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def key_in(spark, data):
    df = table(spark, data, "orders").select("o_orderkey", "o_orderpriority")
    return op.key_in(df, "o_orderpriority", ["1-URGENT", "5-LOW"])


@query("key_not_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def key_not_in(spark, data):
    df = table(spark, data, "orders").select("o_orderkey", "o_orderpriority")
    return op.key_in(df, "o_orderpriority", ["1-URGENT", "5-LOW"], negate=True)


@query(
    "key_ranges",
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey < 50 OR (l_partkey >= 100 AND l_partkey < 120)",
)
def key_ranges(spark, data):
    df = table(spark, data, "lineitem").select("l_orderkey", "l_partkey")
    return op.key_ranges(df, "l_partkey", [(None, 50), (100, 120)])
