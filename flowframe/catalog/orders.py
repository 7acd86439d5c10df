"""Queries of the order process: event tables, hierarchies, nested objects, classification."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import orders as op
from flowframe.operators.hierarchy import hierarchy_root
from flowframe.session import scratch_dir
from flowframe.sources import files, sinks


def headers(spark, data):
    return table(spark, data, "orders").selectExpr(
        "o_orderkey AS sapon", "o_custkey AS custkey", "o_orderpriority AS ordertype", "CAST(o_orderdate AS STRING) AS header_ts"
    )


def lines(spark, data):
    return table(spark, data, "lineitem").selectExpr(
        "l_orderkey AS sapon",
        "l_linenumber AS item",
        "l_partkey AS partkey",
        "l_suppkey AS suppkey",
        "l_returnflag AS flag",
        "l_linestatus AS state",
        "CAST(l_shipdate AS STRING) AS line_ts",
    )


@query(
    "event_details",
    """SELECT o_orderkey AS sapon, o_orderpriority AS ordertype, l_linenumber AS item,
         greatest(CAST(o_orderdate AS VARCHAR), CAST(l_shipdate AS VARCHAR)) AS serial
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def event_details(spark, data):
    df = op.event_details(headers(spark, data), lines(spark, data), ["sapon"], ["header_ts", "line_ts"])
    return df.select("sapon", "ordertype", "item", "serial")


STATUS = """(SELECT 'OR' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') ||
  lpad(CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber END AS VARCHAR), 6, '0') AS objectnumber,
  l_linestatus AS stsma, l_returnflag AS objectstatus, CAST(l_shipdate AS VARCHAR) AS ts FROM lineitem)"""


def status_tables(spark, data):
    """A status log over composite object numbers, its object profiles and status texts."""
    df = table(spark, data, "lineitem")
    item = F.when(F.col("l_linenumber") == 1, 0).otherwise(F.col("l_linenumber"))
    number = F.concat(
        F.lit("OR"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), F.lpad(item.cast("string"), 6, "0")
    )
    base = df.select(
        number.alias("objectnumber"),
        F.col("l_linestatus").alias("stsma"),
        F.col("l_returnflag").alias("objectstatus"),
        F.col("l_shipdate").cast("string").alias("ts"),
    )
    log = base.select("objectnumber", "objectstatus", F.col("ts").alias("log_ts")).distinct()
    profile = base.groupBy("objectnumber").agg(F.min("stsma").alias("stsma"), F.max("ts").alias("profile_ts"))
    texts = base.select("stsma", "objectstatus").distinct().withColumn("text", F.concat("stsma", "objectstatus"))
    return log, profile, texts


@query(
    "event_status",
    f"""WITH base AS (SELECT * FROM {STATUS}), log AS (SELECT DISTINCT objectnumber, objectstatus, ts FROM base),
        profile AS (SELECT objectnumber, min(stsma) AS stsma, max(ts) AS profile_ts FROM base GROUP BY 1),
        texts AS (SELECT DISTINCT stsma, objectstatus, stsma || objectstatus AS text FROM base)
        SELECT objectnumber, text, substr(objectnumber, 3, 10) AS sapon, substr(objectnumber, 13, 6) AS sapitemnum,
          CASE WHEN substr(objectnumber, 13, 6) = '000000' THEN 'header' ELSE 'item' END AS statustype,
          greatest(ts, profile_ts) AS serial
        FROM log JOIN profile USING (objectnumber) JOIN texts USING (stsma, objectstatus)""",
)
def event_status(spark, data):
    log, profile, texts = status_tables(spark, data)
    df = op.event_status(
        log,
        (profile, ["objectnumber"]),
        (texts, ["stsma", "objectstatus"]),
        "objectnumber",
        {"sapon": (3, 10), "sapitemnum": (13, 6)},
        "sapitemnum",
        ["log_ts", "profile_ts"],
    )
    return df.select("objectnumber", "text", "sapon", "sapitemnum", "statustype", "serial")


@query(
    "event_partner",
    """WITH p AS (SELECT o_custkey AS sapon, o_orderstatus AS parvw, n_name, n_regionkey, CAST(o_orderdate AS VARCHAR) AS ts
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         WHERE o_orderstatus IN ('F', 'O'))
       SELECT sapon, max(n_name) FILTER (parvw = 'F') AS soldto, max(n_regionkey) FILTER (parvw = 'F') AS soldtoregion,
         max(n_name) FILTER (parvw = 'O') AS shipto, max(ts) FILTER (parvw = 'F') AS "F_timestamp",
         max(ts) FILTER (parvw = 'O') AS "O_timestamp", max(ts) AS serial FROM p GROUP BY sapon""",
)
def event_partner(spark, data):
    """One row per customer with the address of two partner roles."""
    who = table(spark, data, "customer").select(F.col("c_custkey").alias("sapon"), F.col("c_nationkey").alias("adrnr"))
    partner = table(spark, data, "orders").selectExpr(
        "o_custkey AS sapon", "o_orderstatus AS parvw", "CAST(o_orderdate AS STRING) AS ts"
    )
    address = table(spark, data, "nation").withColumnRenamed("n_nationkey", "adrnr")
    names = {"F": {"n_name": "soldto", "n_regionkey": "soldtoregion"}, "O": {"n_name": "shipto"}}
    return op.event_partner(partner.join(who, "sapon"), (address, ["adrnr"]), ["sapon"], "parvw", names, "ts")


@query("event_schedule", "SELECT l_orderkey AS sapon, l_linenumber AS item, CAST(l_shipdate AS VARCHAR) AS serial FROM lineitem")
def event_schedule(spark, data):
    return op.event_schedule(lines(spark, data), "line_ts").select("sapon", "item", "serial")


@query(
    "event_delivery",
    """SELECT o_orderkey AS sapon, l_linenumber AS item,
         greatest(CAST(o_orderdate AS VARCHAR), CAST(l_shipdate AS VARCHAR)) AS serial
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND l_returnflag <> 'N'""",
)
def event_delivery(spark, data):
    """Only dated headers and lines that refer to an order."""
    dated = headers(spark, data).join(
        table(spark, data, "orders").selectExpr("o_orderkey AS sapon", "nullif(o_orderstatus, 'P') AS dated"), "sapon"
    )
    referring = lines(spark, data).withColumn("reference", F.nullif(F.col("flag"), F.lit("N")))
    df = op.event_delivery(dated, referring, ["sapon"], "dated", "reference", ["header_ts", "line_ts"])
    return df.select("sapon", "item", "serial")


@query(
    "event_purchase",
    """SELECT l_orderkey AS sapon, l_linenumber AS item, p_brand, s_name,
         greatest(CAST(o_orderdate AS VARCHAR), CAST(l_shipdate AS VARCHAR)) AS serial
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
       JOIN supplier ON s_suppkey = l_suppkey""",
)
def event_purchase(spark, data):
    items = lines(spark, data).join(
        table(spark, data, "part").select(F.col("p_partkey").alias("partkey"), "p_brand"), "partkey"
    )
    link = table(spark, data, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_name")
    df = op.event_purchase(headers(spark, data), (items, ["sapon"]), (link, ["suppkey"]), ["header_ts", "line_ts"])
    return df.select("sapon", "item", "p_brand", "s_name", "serial")


@query(
    "hierarchy_root",
    """WITH RECURSIVE n AS (SELECT event_type, event_id + 1 AS item, (event_id + 1) // 2 AS parent FROM events),
       walk AS (SELECT event_type, item, item AS root FROM n WHERE parent = 0
         UNION ALL SELECT n.event_type, n.item, walk.root FROM n JOIN walk ON n.parent = walk.item AND n.event_type = walk.event_type
           WHERE n.parent <> 0)
       SELECT event_type, n.item, coalesce(CAST(walk.root AS VARCHAR), 'n/a') AS root FROM n LEFT JOIN walk USING (event_type, item)""",
)
def hierarchy_root_query(spark, data):
    """A pointer may leave its group: such items end in `n/a`."""
    df = table(spark, data, "events").selectExpr("event_type", "event_id + 1 AS item", "(event_id + 1) div 2 AS parent")
    return hierarchy_root(df, ["event_type"], "item", "parent", "0").select("event_type", "item", "root")


@query(
    "hierarchy_root_deep",
    """WITH RECURSIVE n AS (SELECT event_id + 1 AS item, (event_id + 1) // 2 AS parent FROM events),
       walk AS (SELECT item, 0::BIGINT AS depth FROM n WHERE parent = 0
         UNION ALL SELECT n.item, depth + 1 FROM n JOIN walk ON n.parent = walk.item WHERE n.parent <> 0)
       SELECT '1' AS root, count(*) AS items FROM walk""",
)
def hierarchy_root_deep(spark, data):
    """One tree over all events."""
    df = table(spark, data, "events").selectExpr("'all' AS g", "event_id + 1 AS item", "(event_id + 1) div 2 AS parent")
    return hierarchy_root(df, ["g"], "item", "parent", "0").groupBy("root").agg(F.count("*").alias("items"))


@query(
    "assemble_object",
    """WITH o AS (SELECT o_custkey, to_json(list({'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority}
           ORDER BY o_orderkey)) AS l FROM orders GROUP BY 1),
       i AS (SELECT o_custkey, to_json(list({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber, 'l_partkey': l_partkey}
           ORDER BY l_orderkey, l_linenumber, l_partkey)) AS l
         FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
       SELECT c_custkey, n_name, coalesce(CAST(o.l AS VARCHAR), '[]') AS order_list, coalesce(CAST(i.l AS VARCHAR), '[]') AS line_list
       FROM customer LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN i ON i.o_custkey = c_custkey
       JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 1""",
)
def assemble_object(spark, data):
    """Two independent lists per customer and a required partner; no list is null."""
    parent = table(spark, data, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    made = table(spark, data, "orders").withColumnRenamed("o_custkey", "c_custkey")
    lines = table(spark, data, "lineitem").join(made.select(F.col("o_orderkey").alias("l_orderkey"), "c_custkey"), "l_orderkey")
    df = op.assemble(
        parent,
        {
            "order_list": (made, ["c_custkey"], ["o_orderkey", "o_orderpriority"]),
            "line_list": (lines, ["c_custkey"], ["l_orderkey", "l_linenumber", "l_partkey"]),
        },
        required=[(table(spark, data, "nation").filter("n_regionkey <> 1"), ["n_nationkey"])],
    )
    lists = {c: F.to_json(c) for c in ("order_list", "line_list")}
    return df.withColumns(lists).select("c_custkey", "n_name", "order_list", "line_list")


@query("assemble_object_bounded", "SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem")
def assemble_object_bounded(spark, data):
    """Three parents with very many children each: lists and their overflow hold every child."""
    base = table(spark, data, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    parents = base.select("l_returnflag").distinct()
    objects, overflow = op.assemble_bounded(parents, {"lines": (base, ["l_returnflag"], cols)}, 5000)
    parts = objects.unionByName(overflow["lines"].drop("part"))
    return parts.select("l_returnflag", F.inline("lines"))


@query(
    "assemble_delivery",
    """WITH d AS (SELECT l_orderkey AS delivery, max(l_suppkey) AS own, max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS ext,
         to_json(list({'l_linenumber': l_linenumber, 'l_quantity': CAST(l_quantity AS BIGINT)}
           ORDER BY l_linenumber, CAST(l_quantity AS BIGINT))) AS line_list FROM lineitem GROUP BY 1),
       s AS (SELECT p_partkey AS id, to_json(list({'p_brand': p_brand, 'p_size': p_size} ORDER BY p_brand, p_size)) AS l FROM part GROUP BY 1),
       t AS (SELECT l_orderkey, to_json(list({'flag': flag, 'serial': serial} ORDER BY flag, serial)) AS l FROM
         (SELECT l_orderkey, l_returnflag AS flag, CAST(min(l_shipdate) AS VARCHAR) AS serial FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
         GROUP BY 1)
       SELECT delivery, CAST(line_list AS VARCHAR) AS line_list, coalesce(CAST(s.l AS VARCHAR), '[]') AS shipment_list,
         CAST(t.l AS VARCHAR) AS date_list
       FROM d LEFT JOIN s ON s.id = coalesce(ext, own) JOIN t ON t.l_orderkey = delivery""",
)
def assemble_delivery(spark, data):
    df = op.assemble_delivery(*delivery_inputs(spark, data))
    lists = {c: F.to_json(c) for c in ("line_list", "shipment_list", "date_list")}
    return df.withColumns(lists).select("delivery", *lists)


@query(
    "assemble_delivery_bounded",
    """SELECT 'line' AS kind, count(*) AS n, sum(l_linenumber)::BIGINT AS total FROM lineitem
       UNION ALL SELECT 'date', count(*), NULL FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F')""",
)
def assemble_delivery_bounded(spark, data):
    """Lists of two entries at most or so; with what is beyond them they hold every entry."""
    objects, overflow = op.assemble_delivery_bounded(*delivery_inputs(spark, data), keep_undated=True, max_items=2)

    def every(name):
        return objects.select(name).unionByName(overflow[name].select(name)).select(F.inline(name))

    lines = every("line_list").agg(F.lit("line").alias("kind"), F.count("*").alias("n"), F.sum("l_linenumber").cast("bigint").alias("total"))
    dates = every("date_list").agg(F.lit("date").alias("kind"), F.count("*").alias("n"), F.lit(None).cast("bigint").alias("total"))
    return lines.unionByName(dates)


def delivery_inputs(spark, data):
    base = table(spark, data, "lineitem")
    ids = base.groupBy(F.col("l_orderkey").alias("delivery")).agg(
        F.max("l_suppkey").alias("own"), F.max(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("ext")
    )
    rows = base.select(
        F.col("l_orderkey").alias("delivery"), "l_linenumber", F.col("l_quantity").cast("bigint").alias("l_quantity")
    ).join(ids, "delivery")
    dates = base.filter("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("delivery"), F.col("l_returnflag").alias("flag"), F.col("l_shipdate").cast("string").alias("serial")
    )
    return (
        rows,
        table(spark, data, "part"),
        ["delivery", "own", "ext"],
        ["l_linenumber", "l_quantity"],
        "own",
        "ext",
        F.lit(True),
        "p_partkey",
        ["p_brand", "p_size"],
        dates,
        ["delivery"],
        "flag",
    )


@query(
    "status_scope_union",
    """WITH item AS (SELECT DISTINCT l_orderkey AS sapon, l_linenumber AS item FROM lineitem),
       st AS (SELECT l_orderkey AS sapon, l_linenumber AS item, l_returnflag AS code,
         CASE WHEN l_linenumber = 1 THEN 'header' ELSE 'item' END AS statustype FROM lineitem)
       SELECT sapon, item.item, code, statustype FROM item JOIN (SELECT sapon, code, statustype FROM st WHERE statustype = 'header') USING (sapon)
       UNION ALL SELECT sapon, item, code, statustype FROM item JOIN st USING (sapon, item) WHERE statustype = 'item'""",
)
def status_scope_union(spark, data):
    base = lines(spark, data)
    kind = F.when(F.col("item") == 1, F.lit("header")).otherwise(F.lit("item"))
    status = base.select("sapon", "item", F.col("flag").alias("code"), kind.alias("statustype"))
    heads, items = op.split_scopes(status, "item")
    parents = base.select("sapon", "item").distinct()
    df = op.status_scope_union(parents, heads, items, ["sapon"], ["sapon", "item"])
    return df.select("sapon", "item", "code", "statustype")


@query(
    "classify_group",
    """WITH f AS (SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'R' AND l_quantity >= 40) AS big_return,
         bool_or(l_linestatus = 'O') AS has_open FROM lineitem GROUP BY 1)
       SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND coalesce(big_return, false) THEN 'critical'
         WHEN coalesce(n, 0) > 4 AND coalesce(has_open, false) THEN 'complex' WHEN coalesce(n, 0) > 1 THEN 'several'
         ELSE 'plain' END AS class FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""",
)
def classify_group(spark, data):
    c = F.col
    roots = table(spark, data, "orders").select(c("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    facts = {
        "big_return": (c("l_returnflag") == "R") & (c("l_quantity") >= 40),
        "has_open": c("l_linestatus") == "O",
    }
    rules = [
        ("critical", (c("o_orderpriority") == "1-URGENT") & c("big_return")),
        ("complex", (c("line_count") > 4) & c("has_open")),
        ("several", c("line_count") > 1),
    ]
    df = op.classify_group(roots, table(spark, data, "lineitem"), ["l_orderkey"], facts, rules, "plain", "class")
    return df.select(c("l_orderkey").alias("o_orderkey"), "class")


SHAPES = [
    ("returned", "l_returnflag = 'R' AND has_return AND line_count > 3"),
    ("bulky", "l_quantity >= 40 OR (line_count > 5 AND has_bulk)"),
    ("costly", "l_extendedprice > 50000 AND NOT has_return"),
    ("single", "line_count = 1"),
]


@query(
    "order_complexity",
    """WITH f AS (SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'R') AS ret, bool_or(l_quantity >= 45 AND l_discount > 0.05) AS bulk
         FROM lineitem GROUP BY 1)
       SELECT l_orderkey, CASE WHEN l_returnflag = 'R' AND ret AND n > 3 THEN 'returned' WHEN l_quantity >= 40 OR (n > 5 AND bulk) THEN 'bulky'
         WHEN l_extendedprice > 50000 AND NOT ret THEN 'costly' WHEN n = 1 THEN 'single' ELSE 'plain' END AS shape
       FROM lineitem JOIN f USING (l_orderkey) WHERE l_linenumber = 1""",
)
def order_complexity(spark, data):
    """The first line of each order, labelled by rules over itself and facts about all lines."""
    lines = table(spark, data, "lineitem")
    facts = {"has_return": "l_returnflag = 'R'", "has_bulk": "l_quantity >= 45 AND l_discount > 0.05"}
    df = op.classify_group(lines.filter("l_linenumber = 1"), lines, ["l_orderkey"], facts, SHAPES, "plain", "shape")
    return df.select("l_orderkey", "shape")


@query(
    "lookup_enrich",
    """SELECT l_orderkey, l_linenumber, coalesce(p_brand, '_') AS p_brand, coalesce(s_name, '_') AS s_name FROM lineitem
       LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey
       LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey""",
)
def lookup_enrich(spark, data):
    brands = table(spark, data, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    names = table(spark, data, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    base = table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    df = op.lookup_enrich(base, [(brands, ["l_partkey"]), (names, ["l_suppkey"])])
    return df.select("l_orderkey", "l_linenumber", "p_brand", "s_name")


@query(
    "json_keyed",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         '{"id":' || c_custkey || ',"name":"' || c_name || '"}' AS json FROM customer""",
)
def json_keyed(spark, data):
    df = table(spark, data, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    return op.json_keyed(files.rows_as_json(df), ["id", "name"])


@query(
    "refresh_lookup",
    """SELECT CAST(o_custkey AS VARCHAR) AS material, o_orderpriority AS family FROM orders
       WHERE strftime(o_orderdate, '%Y%m') BETWEEN '199801' AND '199812'""",
)
def refresh_lookup(spark, data):
    """A lookup rebuilt from its monthly parts replaces the one there was."""
    parts, target = scratch_dir(spark, "parts"), scratch_dir(spark, "lookup")
    base = table(spark, data, "orders").select(
        "o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyyMM").alias("yearmonth")
    )
    sinks.write_files(base, parts, partition_cols=["yearmonth"])
    sinks.write_files(base.filter("o_orderpriority = '1-URGENT'"), target)
    fresh = files.read_month_partitions(
        spark, parts, {"o_custkey": "material", "o_orderpriority": "family"}, None, "", "199801", "199812"
    )
    sinks.write_files(fresh.withColumn("material", F.col("material").cast("string")), target)
    return spark.read.parquet(target)


@query("load_events_since", "SELECT l_orderkey AS sapon, l_linenumber AS item, CAST(l_shipdate AS VARCHAR) AS serial FROM lineitem WHERE l_shipdate > TIMESTAMP '2000-01-01'")
def load_events_since(spark, data):
    df = op.event_schedule(lines(spark, data), "line_ts")
    return op.load_events_since(df, "2000-01-01 00:00:00").select("sapon", "item", "serial")


@query("flagged_lookup", "SELECT DISTINCT trim(p_brand || '  ') AS brand, 'Y' AS mapped FROM part")
def flagged_lookup(spark, data):
    padded = table(spark, data, "part").select(F.concat("p_brand", F.lit("  ")).alias("p_brand"))
    return op.flagged_lookup(padded, "p_brand", "brand", "mapped")


@query(
    "result_rows",
    """SELECT o_custkey || '_' || o_orderkey || '_v3' AS row_key,
         '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS json
       FROM orders""",
)
def result_rows(spark, data):
    df = table(spark, data, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return op.result_rows(df, ["o_custkey", "o_orderkey"], "v3")
