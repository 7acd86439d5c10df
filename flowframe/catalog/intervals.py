"""Queries of status intervals, holds, milestones and schedule dates."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import intervals as op
from flowframe.operators.orders import decide


def status_log(spark, data):
    """Events as a status log: per user and type, events open and close in turn.

    Change numbers count the events of a user by id; `signup` and `error` rows are inactive
    and carry the code of the row type they close.
    """
    return table(spark, data, "events").select(
        F.col("user_id"),
        F.when(F.col("event_type").isin("click", "error"), "header").otherwise("item").alias("statustype"),
        F.lit("S").alias("objectstatuscode"),
        F.get_json_object("props", "$.k").alias("objectchangenum"),
        F.when(F.col("event_type").isin("signup", "error"), F.lit("X")).alias("objectinactive"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("starttime"),
    )


LOG = """(SELECT user_id, CASE WHEN event_type IN ('click', 'error') THEN 'header' ELSE 'item' END AS statustype,
  'S' AS statevalue, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n, event_type IN ('signup', 'error') AS closed,
  strftime(ts, '%Y%m%d%H%M%S') AS starttime FROM events)"""
INTERVALS = f"""(SELECT o.user_id, o.statustype, o.n AS changenum, o.statevalue, o.starttime, coalesce(c.endtime, '') AS endtime
  FROM {LOG} o LEFT JOIN (SELECT user_id, statustype, statevalue, n - 1 AS n, max(starttime) AS endtime FROM {LOG} WHERE closed GROUP BY ALL) c
    ON o.user_id = c.user_id AND o.statustype = c.statustype AND o.statevalue = c.statevalue AND o.n = c.n WHERE NOT o.closed)"""


@query("status_intervals", f"SELECT * FROM {INTERVALS}")
def status_intervals(spark, data):
    return op.status_intervals(status_log(spark, data), ["user_id"])


def coded_intervals(spark, data):
    """Intervals under the codes A..E, by change number."""
    df = op.status_intervals(status_log(spark, data), ["user_id"])
    code = F.element_at(F.split(F.lit("A,B,C,D,E"), ","), (F.col("changenum") % 5 + 1).cast("int"))
    return df.withColumn("statevalue", code)


HOLDS = {("header", "A"): 30, ("header", "B"): 10, ("item", "C"): 10, ("item", "D"): 20, ("item", "A"): 5}


@query(
    "active_min_sequence",
    f"""WITH i AS (SELECT * EXCLUDE (statevalue), substr('ABCDE', CAST(changenum % 5 + 1 AS INTEGER), 1) AS statevalue FROM {INTERVALS}),
        h(statustype, statevalue, sequence) AS (VALUES ('header', 'A', 30), ('header', 'B', 10), ('item', 'C', 10), ('item', 'D', 20), ('item', 'A', 5)),
        r AS (SELECT user_id, statustype, statevalue, sequence, starttime, row_number() OVER (PARTITION BY user_id
          ORDER BY sequence, CASE statustype WHEN 'item' THEN 0 ELSE 1 END, statevalue, starttime DESC) AS rn
          FROM i JOIN h USING (statustype, statevalue) WHERE endtime = '')
        SELECT user_id, statevalue, starttime, '' AS endtime, 'statustype:' || statustype || ' | sequence: ' || sequence AS trace
        FROM r WHERE rn = 1""",
)
def active_min_sequence(spark, data):
    return op.active_min_sequence(coded_intervals(spark, data), HOLDS, ["user_id"])


FLAG_CODES = {"300": ["BBLK"], "010": ["1SLT", "2SLT"], "007": ["1SLT", "2SLT"], "016": ["1SLT", "2SLT"]}


@query(
    "status_flag_intervals",
    f"""WITH i AS (SELECT *, CASE WHEN user_id < 40 THEN '300' ELSE '010' END AS client,
          CASE changenum % 3 WHEN 0 THEN 'BBLK' WHEN 1 THEN '1SLT' ELSE '2SLT' END AS code FROM {INTERVALS})
        SELECT user_id, client, code AS statevalue, starttime, endtime FROM i WHERE statustype = 'header'
          AND ((client = '300' AND code = 'BBLK') OR (client = '010' AND code IN ('1SLT', '2SLT')))""",
)
def status_flag_intervals(spark, data):
    code = F.element_at(F.array(F.lit("BBLK"), F.lit("1SLT"), F.lit("2SLT")), (F.col("changenum") % 3 + 1).cast("int"))
    df = op.status_intervals(status_log(spark, data), ["user_id"]).withColumns(
        {"client": F.when(F.col("user_id") < 40, "300").otherwise("010"), "statevalue": code}
    )
    return op.status_flag_intervals(df, FLAG_CODES).select("user_id", "client", "statevalue", "starttime", "endtime")


@query(
    "milestone_chain",
    """WITH f AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS returned, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1),
       m AS (SELECT o_orderkey, unnest([1, 2, 3, 4]) AS seq, unnest(['ordered', 'skipped', 'returned', 'shipped']) AS milestone,
         unnest([CAST(o_orderdate AS VARCHAR), CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, CAST(returned AS VARCHAR), CAST(shipped AS VARCHAR)]) AS starttime
         FROM orders LEFT JOIN f ON o_orderkey = l_orderkey)
       SELECT o_orderkey, seq, milestone, starttime, coalesce(lead(starttime) OVER (PARTITION BY o_orderkey ORDER BY seq), '') AS endtime
       FROM m WHERE starttime <> ''""",
)
def milestone_chain(spark, data):
    facts = table(spark, data, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("returned"), F.max("l_shipdate").alias("shipped")
    )
    df = table(spark, data, "orders").join(facts, "o_orderkey", "left")
    steps = [
        (3, "returned", F.col("returned")),
        (1, "ordered", F.col("o_orderdate")),
        (2, "skipped", F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))),
        (4, "shipped", F.col("shipped")),
    ]
    return op.milestone_chain(df, ["o_orderkey"], steps)


@query(
    "source_region",
    """SELECT o_orderkey, CASE WHEN o_custkey % 10 < 4 AND o_orderpriority <> '5-LOW' THEN 'north' WHEN o_custkey % 10 < 7 THEN 'east' END AS region FROM orders""",
)
def source_region(spark, data):
    """Ordered rules given as SQL; without a match there is no region."""
    rules = [("north", "o_custkey % 10 < 4 AND o_orderpriority <> '5-LOW'"), ("east", "o_custkey % 10 < 7")]
    return table(spark, data, "orders").select("o_orderkey", decide(rules).alias("region"))


FLOW_RULES = [
    ("urgent", "o_orderpriority = '1-URGENT'"),
    ("unsupplied", "open_supplier = ''"),
    ("same", "open_supplier = closed_supplier"),
    ("near", "CAST(open_supplier AS INT) % 4 = o_custkey % 4"),
    ("late", "o_orderstatus = 'O' AND closed_supplier = ''"),
]


@query(
    "region_flow_rules",
    """WITH l AS (SELECT l_orderkey, l_linestatus, strftime(l_shipdate, '%Y%m%d') || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS serial,
         CAST(l_suppkey AS VARCHAR) AS supplier FROM lineitem WHERE l_returnflag <> 'R'),
       p AS (SELECT l_orderkey, arg_max(supplier, (serial, supplier)) FILTER (l_linestatus = 'O') AS o,
         arg_max(supplier, (serial, supplier)) FILTER (l_linestatus = 'F') AS f FROM l GROUP BY 1)
       SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' WHEN coalesce(o, '') = '' THEN 'unsupplied' WHEN o = coalesce(f, '') THEN 'same'
         WHEN CAST(o AS INT) % 4 = o_custkey % 4 THEN 'near' WHEN o_orderstatus = 'O' AND coalesce(f, '') = '' THEN 'late' ELSE 'other' END AS flow
       FROM orders LEFT JOIN p ON o_orderkey = l_orderkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def region_flow_rules(spark, data):
    """Rules over an order and the latest of its lines of each status that were not returned."""
    serial = F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"))
    lines = table(spark, data, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    wanted = {n: f"l_returnflag <> 'R' AND l_linestatus = '{s}'" for n, s in (("open_supplier", "O"), ("closed_supplier", "F"))}
    latest = op.latest_values(lines, ["o_orderkey"], serial, F.col("l_suppkey").cast("string"), wanted)
    df = table(spark, data, "orders").join(latest, "o_orderkey")
    return df.select("o_orderkey", decide(FLOW_RULES, "other").alias("flow"))


def schedule_lines(spark, data):
    c = F.col
    return table(spark, data, "lineitem").select(
        c("l_partkey").alias("item"),
        F.when(c("l_partkey") % 2 == 0, "300").otherwise("010").alias("client"),
        F.when(c("l_partkey") % 3 == 0, "Hub").otherwise("Direct").alias("flowtype"),
        F.when(c("l_returnflag") == "R", 0).otherwise(c("l_quantity")).alias("schedulelineconfirmedqty"),
        F.date_format(F.expr("l_shipdate + INTERVAL 20 DAYS"), "yyyyMMdd").alias("plannedfactoryshipdate"),
        F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("serial"),
        F.concat_ws("-", F.lpad(c("l_orderkey").cast("string"), 9, "0"), "l_linenumber", "l_suppkey", c("l_quantity").cast("int").cast("string")).alias("schedulelinenum"),
        F.lit("19980101000000").alias("atpserial"),
    )


# adding nine, seven or two working days, by weekday
def plus_days(day, n):
    return f"""({day} + CAST(CASE WHEN {n} = 2 THEN CASE isodow({day}) WHEN 4 THEN 4 WHEN 5 THEN 4 WHEN 6 THEN 3 ELSE 2 END
      WHEN {n} = 7 THEN CASE isodow({day}) WHEN 1 THEN 9 WHEN 2 THEN 9 WHEN 3 THEN 9 WHEN 4 THEN 11 WHEN 5 THEN 11 WHEN 6 THEN 10 ELSE 9 END
      ELSE CASE isodow({day}) WHEN 1 THEN 11 WHEN 6 THEN 12 WHEN 7 THEN 11 ELSE 13 END END AS INTEGER))"""


@query(
    "schedule_commit_dates",
    f"""WITH s AS (SELECT l_partkey AS item, l_partkey % 2 = 0 AS newer, l_partkey % 3 = 0 AS hub,
          CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END >= 1 AS confirmed, CAST(l_shipdate AS DATE) + 20 AS ship,
          CAST(l_shipdate AS DATE) AS own, strftime(l_shipdate, '%Y%m%d%H%M%S') AS serial,
          concat_ws('-', lpad(CAST(l_orderkey AS VARCHAR), 9, '0'), l_linenumber, l_suppkey, CAST(l_quantity AS INTEGER)) AS line FROM lineitem),
        f AS (SELECT *, CASE WHEN serial = max(serial) OVER (PARTITION BY item) THEN DATE '2001-06-15' ELSE own END AS base,
          newer AND serial <= '19980101000000' AS checked FROM s),
        d AS (SELECT *, CASE WHEN confirmed AND checked THEN CASE WHEN hub THEN {plus_days('base', 9)} END
          WHEN confirmed THEN CASE WHEN hub THEN {plus_days('ship', 2)} ELSE ship END
          WHEN hub THEN {plus_days('base', 9)} ELSE {plus_days('base', 7)} END AS day FROM f),
        c AS (SELECT item, line AS schedulelinenum, serial AS starttime,
          last_value(day IGNORE NULLS) OVER (PARTITION BY item ORDER BY serial, line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS day,
          coalesce(lead(serial) OVER (PARTITION BY item ORDER BY serial, line), '') AS endtime FROM d)
        SELECT item, schedulelinenum, strftime(day, '%Y%m%d') AS datevalue, starttime, endtime FROM c WHERE day IS NOT NULL""",
)
def schedule_commit_dates(spark, data):
    return op.schedule_commit_dates(schedule_lines(spark, data), ["item"], "2001-06-15", hub_flows=["Hub"], newer=["300"], older=["010"])
