"""Queries of change-driven operators."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import incremental as op
from flowframe.session import scratch_dir

DAY = "2024-01-15 00:00:00"
TILL = "2024-01-20 00:00:00"


def _events(spark, data):
    return table(spark, data, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("string").alias("ts"))


EVENTS = "(SELECT event_id, user_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events)"


@query("new_rows", f"SELECT * FROM {EVENTS} WHERE ts <= '{TILL}' EXCEPT SELECT * FROM {EVENTS} WHERE ts <= '{DAY}'")
def new_rows(spark, data):
    df = _events(spark, data)
    return op.new_rows(df, df.filter(F.col("ts") <= DAY), "ts", TILL)[0]


@query("new_rows_next", f"SELECT * FROM {EVENTS} WHERE ts <= '{TILL}'")
def new_rows_next(spark, data):
    """The snapshot after the pull, stored durably and read back."""
    df = _events(spark, data)
    store = op.SnapshotStore(spark, scratch_dir(spark, "snapshots"))
    store.save(df.filter(F.col("ts") <= DAY), 1)
    _, following = op.new_rows(df, store.latest(before=2), "ts", TILL)
    return store.save(following, 2)


@query(
    "new_rows_ignore_ts",
    f"""WITH e AS (SELECT user_id, value, CAST(ts AS VARCHAR) AS ts FROM events)
        SELECT user_id, value, ts FROM e a WHERE ts <= '{TILL}' AND NOT EXISTS (SELECT 1 FROM e b
        WHERE b.ts <= '{DAY}' AND a.user_id = b.user_id AND a.value = b.value)""",
)
def new_rows_ignore_ts(spark, data):
    df = table(spark, data, "events").select("user_id", "value", F.col("ts").cast("string").alias("ts"))
    return op.new_rows(df, df.filter(F.col("ts") <= DAY), "ts", TILL, ignore=["ts"])[0]


@query("timed_table", f"SELECT * FROM {EVENTS} WHERE ts <= '{TILL}' AND ts > '{DAY}'")
def timed_table(spark, data):
    df = _events(spark, data)
    return op.timed_table(df, df.filter(F.col("ts") <= DAY), "ts", TILL).new


def _views(spark, data):
    """Orders and lines before and after a day in 1998."""
    heads = table(spark, data, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_orderdate")
    lines = table(spark, data, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey", "l_shipdate"
    )
    return (
        op.TimeView(heads.filter("o_orderdate < '1998-06-01'"), heads.filter("o_orderdate >= '1998-06-01'")),
        op.TimeView(lines.filter("l_shipdate < '1998-06-01'"), lines.filter("l_shipdate >= '1998-06-01'")),
    )


LATER = "NOT (o_orderdate < TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-06-01')"


@query(
    "join_delta",
    f"""SELECT o_orderkey AS orderkey, o_custkey, l_linenumber, l_partkey FROM orders
        JOIN lineitem ON o_orderkey = l_orderkey WHERE {LATER}""",
)
def join_delta(spark, data):
    left, right = _views(spark, data)
    df = op.join_delta(left.previous, left.new, right.all, right.new, ["orderkey"])
    return df.select("orderkey", "o_custkey", "l_linenumber", "l_partkey")


@query("union_delta", f"SELECT * FROM {EVENTS} WHERE ts > '{DAY}' UNION ALL SELECT * FROM {EVENTS} WHERE ts > '{TILL}'")
def union_delta(spark, data):
    df = _events(spark, data)
    left = op.TimeView(df.filter(F.col("ts") <= DAY), df.filter(F.col("ts") > DAY))
    right = op.TimeView(df.filter(F.col("ts") <= TILL), df.filter(F.col("ts") > TILL))
    return op.union_delta(left, right).new


@query(
    "backfill_then_catch_up",
    """SELECT event_id, CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN 0 ELSE
         CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10')) / 86400000000) AS BIGINT) END AS pull
       FROM events WHERE ts <= TIMESTAMP '2024-01-28 12:00:00'""",
)
def backfill_then_catch_up(spark, data):
    df = table(spark, data, "events")
    return op.catch_up(df, "ts", "2024-01-10 00:00:00", "2024-01-28 12:00:00").select("event_id", "pull")


@query(
    "catch_up_counts",
    """SELECT CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN 0 ELSE
         CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10')) / 604800000000) AS BIGINT) END AS pull,
         count(*) AS rows FROM events GROUP BY 1""",
)
def catch_up_counts(spark, data):
    """The increment is honoured: weekly instead of daily pulls."""
    df = op.catch_up(table(spark, data, "events"), "ts", "2024-01-10 00:00:00", "2025-01-01 00:00:00", "7 days")
    return df.groupBy("pull").agg(F.count("*").alias("rows"))


@query(
    "resume_from_landed",
    """SELECT user_id, event_type, CAST(ts AS VARCHAR) AS ts, 'previous' AS part FROM
       (SELECT *, max(ts) OVER (PARTITION BY user_id) AS best FROM events) WHERE ts = best""",
)
def resume_from_landed(spark, data):
    """State comes from what was landed; nothing counts as new."""
    path = scratch_dir(spark, "landed")
    table(spark, data, "events").select("user_id", "event_type", "ts").write.parquet(path)
    view = op.resume_from_landed(spark.read.parquet(path), ["user_id"], "ts")
    both = view.previous.withColumn("part", F.lit("previous")).unionByName(view.new.withColumn("part", F.lit("new")))
    return both.withColumn("ts", F.col("ts").cast("string"))


@query(
    "propagate_changes",
    f"""SELECT o_orderkey AS orderkey, l_linenumber, l_partkey AS partkey, p_brand FROM orders
        JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
        WHERE {LATER} OR p_size > 40""",
)
def propagate_changes(spark, data):
    """Three tables change at once; the result is exactly what the full join gained."""
    heads, lines = _views(spark, data)
    parts = table(spark, data, "part").select(F.col("p_partkey").alias("partkey"), "p_brand", "p_size")
    named = op.TimeView(*[v.withColumnRenamed("l_partkey", "partkey") for v in (lines.previous, lines.new)])
    changed = op.TimeView(parts.filter("p_size <= 40"), parts.filter("p_size > 40"))
    df = op.propagate_changes(heads, [(named, ["orderkey"]), (changed, ["partkey"])]).new
    return df.select("orderkey", "l_linenumber", "partkey", "p_brand")


MONTHS = ("199305", "199611", "199802")


@query(
    "new_rows_by_month",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS yearmonth FROM orders
        WHERE strftime(o_orderdate, '%Y%m') IN {MONTHS} AND o_orderkey % 7 = 0""",
)
def new_rows_by_month(spark, data):
    """A table by month of which three months gain rows, and others are written again as they were."""
    month = F.date_format("o_orderdate", "yyyyMM")
    orders = table(spark, data, "orders").select("o_orderkey", "o_custkey", "o_totalprice", month.alias("yearmonth"))
    path, store = scratch_dir(spark, "orders-by-month"), op.MonthStore(spark, scratch_dir(spark, "month-state"))
    late = F.col("yearmonth").isin(*MONTHS) & (F.col("o_orderkey") % 7 == 0)
    orders.filter(~late).write.partitionBy("yearmonth").parquet(path)
    store.pull(spark.read.parquet(path), "yearmonth", 0)
    again = orders.filter(F.col("yearmonth").isin(*MONTHS) | F.col("yearmonth").startswith("1995"))
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("yearmonth").parquet(path)
    gained = store.pull(spark.read.parquet(path), "yearmonth", 1)
    return gained.withColumn("yearmonth", F.col("yearmonth").cast("string"))
