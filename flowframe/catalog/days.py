"""Queries of timestamps and working days."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.functions import bizdays as bd
from flowframe.functions.timestamps import parse_timestamp_any


def days(spark, data):
    return table(spark, data, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_custkey")


DAYS = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_custkey FROM orders)"


@query(
    "parse_timestamp_any",
    """SELECT o_orderkey, CASE o_orderpriority
         WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00.000Z')
         WHEN '2-HIGH' THEN strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:00:00.000Z')
         WHEN '3-MEDIUM' THEN strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%dT%H:00:00.000Z')
         WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%dT%H:00:00.000Z') END AS ts,
       o_orderpriority = '5-LOW' AS failed FROM orders""",
)
def parse_timestamp(spark, data):
    """Zoned, with an offset, local by pattern, local date, and a text that is none."""
    priority, d = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(priority == "1-URGENT", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(priority == "2-HIGH", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(priority == "3-MEDIUM", F.date_format(d, "dd.MM.yyyy HH:mm"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.lit("yesterday"))
    )
    df = table(spark, data, "orders").select("o_orderkey", parse_timestamp_any(text, "dd.MM.yyyy HH:mm", "-05:00").alias("p"))
    return df.select("o_orderkey", "p.ts", (F.col("p.error") != "").alias("failed"))


def weekdays(first, last):
    """SQL: working days among the dates `first`..`last`."""
    return f"(SELECT count(*) FROM unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) t(x) WHERE isodow(x) <= 5)"


# the calendar twin: the n-th working day on the other side is found by counting
def nth(sign):
    step = f"d {sign} CAST(i AS INTEGER)"
    return f"""SELECT o_orderkey, d, x FROM (SELECT o_orderkey, d, {step} AS x,
        row_number() OVER (PARTITION BY o_orderkey ORDER BY i) AS k FROM {DAYS}, range(1, 20) r(i) WHERE isodow({step}) <= 5) WHERE k = 9"""


@query("workday_add", nth("+"))
def workday_add(spark, data):
    return days(spark, data).select("o_orderkey", "d", bd.add_workdays(F.col("d"), 9).alias("x"))


@query("workday_subtract", nth("-"))
def workday_subtract(spark, data):
    return days(spark, data).select("o_orderkey", "d", bd.subtract_workdays(F.col("d"), 9).alias("x"))


@query(
    "workdays_between",
    """SELECT o_orderkey, l_linenumber, CAST((SELECT count(*) FROM range(0, greatest(CAST(datediff('day', o_orderdate, l_shipdate) AS BIGINT), 0)) r(i)
         WHERE isodow(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER)) <= 5) AS INTEGER) AS n
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def workdays_between(spark, data):
    lines = table(spark, data, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped")
    )
    df = days(spark, data).join(lines, "o_orderkey")
    return df.select("o_orderkey", "l_linenumber", bd.workdays_between(F.col("d"), F.col("shipped")).alias("n"))


@query("last_day_of_month", f"SELECT o_orderkey, last_day(d) AS x FROM {DAYS}")
def last_day_of_month(spark, data):
    return days(spark, data).select("o_orderkey", bd.last_day_of_month(F.col("d")).alias("x"))


@query(
    "last_workday_of_month",
    f"SELECT o_orderkey, last_day(d) - CAST(greatest(isodow(last_day(d)) - 5, 0) AS INTEGER) AS x FROM {DAYS}",
)
def last_workday_of_month(spark, data):
    return days(spark, data).select("o_orderkey", bd.last_workday_of_month(F.col("d")).alias("x"))


@query(
    "last_workday_of_quarter",
    f"""SELECT o_orderkey, e - CAST(greatest(isodow(e) - 5, 0) AS INTEGER) AS x FROM (SELECT o_orderkey, last_day(make_date(
          CASE WHEN month(d) >= 11 THEN year(d) + 1 ELSE year(d) END,
          CASE WHEN month(d) IN (11, 12, 1) THEN 1 WHEN month(d) <= 4 THEN 4 WHEN month(d) <= 7 THEN 7 ELSE 10 END, 1)) AS e FROM {DAYS})""",
)
def last_workday_of_quarter(spark, data):
    return days(spark, data).select("o_orderkey", bd.last_workday_of_quarter(F.col("d")).alias("x"))


@query("parse_day", f"SELECT o_orderkey, d, d AS e FROM {DAYS}")
def parse_day(spark, data):
    """Both spellings of a day."""
    d = F.col("d")
    return days(spark, data).select(
        "o_orderkey",
        bd.parse_day(F.date_format(d, "yyyyMMddHHmmss")).alias("d"),
        bd.parse_day(F.date_format(d, "yyyy-MM-dd HH:mm")).alias("e"),
    )
