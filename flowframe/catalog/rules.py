"""Queries of user-written row rules."""

import base64

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import rules as op

SCRIPT = '''
def price_band(context, row):
    """Band of an order by its price and the limits of the context."""
    price = row["o_totalprice"]
    row["band"] = "high" if price >= context["high"] else "mid" if price >= context["mid"] else "low"
    return row


def priority_number(context, row):
    row["number"] = int(row["o_orderpriority"][0])
    if context["object"] == "order" and row["band"] == "high":
        row["number"] += 10
    return row


def refuse(context, row):
    if row["o_orderstatus"] == "P":
        raise ValueError("status " + row["o_orderstatus"])
    row["band"] = "seen"
    return row
'''
CONTEXT = {"object": "order", "high": 400000.0, "mid": 100000.0}
BANDS = "CASE WHEN o_totalprice >= 400000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid' ELSE 'low' END"
COLS = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]


def orders(spark, data):
    return table(spark, data, "orders").select(*COLS)


@query("rule_script", f"SELECT o_orderkey, {BANDS} AS band FROM orders")
def rule_script(spark, data):
    funcs = op.load_functions(base64.b64encode(SCRIPT.encode()).decode(), ["price_band"], encoded=True)
    return op.apply_rules(orders(spark, data), funcs, "o_orderkey bigint, band string", CONTEXT).drop("_error")


@query(
    "rule_chain",
    f"""SELECT o_orderkey, band, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + CASE WHEN band = 'high' THEN 10 ELSE 0 END AS number
        FROM (SELECT *, {BANDS} AS band FROM orders)""",
)
def rule_chain(spark, data):
    """Functions in order over one row, with a shared context."""
    funcs = op.load_functions(SCRIPT, ["price_band", "priority_number"])
    return op.apply_rules(orders(spark, data), funcs, "o_orderkey bigint, band string, number bigint", CONTEXT).drop("_error")


@query(
    "rule_error_rows",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN {BANDS} ELSE 'seen' END AS band,
          CASE WHEN o_orderstatus = 'P' THEN 'refuse: ValueError: status P' END AS error FROM orders""",
)
def rule_error_rows(spark, data):
    """A row whose rule fails is kept as it was before that rule."""
    funcs = op.load_functions(SCRIPT, ["price_band", "refuse"])
    df = op.apply_rules(orders(spark, data), funcs, "o_orderkey bigint, band string", CONTEXT)
    return df.withColumnRenamed("_error", "error")


def add_region(context, row):
    row["region"] = row["r_name"] or context["missing"]
    return row


@query("rule_dependencies", "SELECT n_nationkey, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def rule_dependencies(spark, data):
    """A lookup is joined to the rows; constants reach the rules through their context."""
    region = table(spark, data, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = table(spark, data, "nation").join(region, "n_regionkey", "left")
    df = op.apply_rules(joined, [add_region], "n_nationkey int, region string", {"missing": "none"})
    return df.select("n_nationkey", "region")


@query("rule_join_lookup", "SELECT n_nationkey, upper(r_name) AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def rule_join_lookup(spark, data):
    """The lookup joined first, the rule applied to the joined row."""
    joined = table(spark, data, "nation").join(
        table(spark, data, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )

    def shout(context, row):
        row["region"] = row["r_name"].upper()
        return row

    return op.apply_rules(joined, [shout], "n_nationkey int, region string").select("n_nationkey", F.col("region"))
