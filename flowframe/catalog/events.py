"""Queries of aggregation and event-time shaping."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import events as op
from flowframe.operators import nesting


def text_ts(df, *cols):
    return df.withColumns({c: F.col(c).cast("string") for c in cols or ("ts",)})


@query(
    "freshest_rows",
    """SELECT event_type, user_id, CAST(ts AS VARCHAR) AS ts, event_id, value FROM (SELECT *, max(ts) OVER
       (PARTITION BY user_id, event_type) AS best FROM events) WHERE ts = best""",
)
def freshest_rows(spark, data):
    df = table(spark, data, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return text_ts(op.freshest_rows(df, ["user_id", "event_type"], "ts"))


@query(
    "freshest_rows_ties",
    """SELECT l_suppkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_orderkey, l_linenumber FROM
       (SELECT *, max(l_shipdate) OVER (PARTITION BY l_suppkey) AS best FROM lineitem) WHERE l_shipdate = best""",
)
def freshest_rows_ties(spark, data):
    df = table(spark, data, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return text_ts(op.freshest_rows(df, ["l_suppkey"], "l_shipdate"), "l_shipdate")


@query(
    "current_state",
    """SELECT DISTINCT l_partkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_returnflag FROM
       (SELECT *, max(l_shipdate) OVER (PARTITION BY l_partkey) AS best FROM lineitem) WHERE l_shipdate = best""",
)
def current_state(spark, data):
    df = table(spark, data, "lineitem").select("l_partkey", "l_shipdate", "l_returnflag")
    return text_ts(op.current_state(df, ["l_partkey"], "l_shipdate"), "l_shipdate")


def _repeated(spark, data):
    """Every event again one hour later, under a new id."""
    df = table(spark, data, "events").select("event_id", "user_id", "event_type", "value", "ts")
    again = df.withColumns({"ts": F.expr("ts + INTERVAL 1 HOUR"), "event_id": F.col("event_id") + 1000000000})
    return df.unionByName(again)


REPEATED = """(SELECT event_id, user_id, event_type, value, ts FROM events UNION ALL
  SELECT event_id + 1000000000, user_id, event_type, value, ts + INTERVAL 1 HOUR FROM events)"""


@query(
    "dedup_oldest",
    f"SELECT user_id, event_type, value, CAST(min(ts) AS VARCHAR) AS ts FROM {REPEATED} GROUP BY user_id, event_type, value",
)
def dedup_oldest(spark, data):
    return text_ts(op.dedup_oldest(_repeated(spark, data).drop("event_id"), "ts"))


@query(
    "dedup_oldest_ignore",
    f"""SELECT event_id, user_id, event_type, value, CAST(ts AS VARCHAR) AS ts FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id, event_type, value ORDER BY ts, event_id) AS rn FROM {REPEATED}) WHERE rn = 1""",
)
def dedup_oldest_ignore(spark, data):
    return text_ts(op.dedup_oldest(_repeated(spark, data), "ts", ignore=["event_id"]))


@query(
    "earliest_per_row",
    """SELECT l_partkey, l_suppkey, l_returnflag, CAST(min(l_shipdate) AS VARCHAR) AS l_shipdate FROM lineitem
       GROUP BY l_partkey, l_suppkey, l_returnflag""",
)
def earliest_per_row(spark, data):
    df = table(spark, data, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    return text_ts(op.earliest_per_row(df, "l_shipdate"), "l_shipdate")


JOINED = """(SELECT o_orderkey AS orderkey, o_orderdate, l_shipdate, l_linenumber, l_partkey, l_suppkey,
  greatest(o_orderdate, l_shipdate) AS event_ts FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""
EVENT_COLS = """orderkey, CAST(event_ts AS VARCHAR) AS event_ts, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
  CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_linenumber, l_partkey, l_suppkey"""
TO_EVENTS = f"""SELECT {EVENT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY orderkey, event_ts ORDER BY
  l_shipdate DESC NULLS LAST, o_orderdate DESC NULLS LAST, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM {JOINED}) WHERE rn = 1"""


def _sides(spark, data):
    left = table(spark, data, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    right = table(spark, data, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return left, right


@query("to_events", TO_EVENTS)
def to_events(spark, data):
    left, right = _sides(spark, data)
    df = op.to_events(left.join(right, "orderkey"), ["orderkey"], "o_orderdate", "l_shipdate", "event_ts")
    return text_ts(df, "event_ts", "o_orderdate", "l_shipdate")


@query(
    "to_events_strict",
    f"""WITH rows AS (SELECT * FROM {JOINED}),
        r AS (SELECT orderkey, event_ts, o_orderdate, max(l_shipdate) AS l_shipdate FROM rows GROUP BY ALL),
        b AS (SELECT orderkey, event_ts, l_shipdate, max(o_orderdate) AS o_orderdate FROM r GROUP BY ALL)
        SELECT {EVENT_COLS} FROM b JOIN rows USING (orderkey, event_ts, o_orderdate, l_shipdate)""",
)
def to_events_strict(spark, data):
    left, right = _sides(spark, data)
    joined = left.join(right, "orderkey")
    df = op.to_events(joined, ["orderkey"], "o_orderdate", "l_shipdate", "event_ts", strict_compat=True)
    return text_ts(df, "event_ts", "o_orderdate", "l_shipdate")


@query("join_to_events", TO_EVENTS)
def join_to_events(spark, data):
    left, right = _sides(spark, data)
    df = op.join_to_events(left, right, ["orderkey"], ["orderkey"], "o_orderdate", "l_shipdate", "event_ts")
    return text_ts(df, "event_ts", "o_orderdate", "l_shipdate")


@query(
    "event_serial",
    """SELECT o_orderkey AS orderkey, l_linenumber, CAST(greatest(o_orderdate, l_shipdate) AS VARCHAR) AS serial
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def event_serial(spark, data):
    left, right = _sides(spark, data)
    df = op.event_serial(left.join(right, "orderkey"), ["o_orderdate", "l_shipdate"])
    return text_ts(df, "serial").select("orderkey", "l_linenumber", "serial")


@query(
    "first_seen_value",
    """SELECT user_id, event_type, CAST(min(ts) AS VARCHAR) AS ts FROM events WHERE event_type <> 'error'
       GROUP BY user_id, event_type""",
)
def first_seen_value(spark, data):
    df = table(spark, data, "events").withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))
    return text_ts(op.first_seen_value(df, ["user_id"], "event_type", "ts"))


@query(
    "collect_children",
    """SELECT l_orderkey, CAST(to_json(list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey}
       ORDER BY l_linenumber, l_partkey)) AS VARCHAR) AS lines FROM lineitem GROUP BY l_orderkey""",
)
def collect_children(spark, data):
    df = nesting.collect_children(table(spark, data, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"], "lines")
    return df.withColumn("lines", F.to_json("lines"))


@query("group_count", "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL")
def group_count(spark, data):
    return op.group_count(table(spark, data, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("distinct_topics", "SELECT DISTINCT event_type FROM events")
def distinct_topics(spark, data):
    return op.distinct_values(table(spark, data, "events"), "event_type")
