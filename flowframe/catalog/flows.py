"""Queries of declared flows."""

import base64

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators.incremental import SnapshotStore
from flowframe.operators.rules import load_functions
from flowframe.plans import delta, flow
from flowframe.session import scratch_dir


def connection(name, path, fmt="PARQUET"):
    return {"id": name, "connectionType": "local", "options": {"path": path, "filesFormat": fmt}}


def op(kind, sources, sinks, connection_in=None, connection_out=None, **options):
    ins = [{"signalId": s} for s in sources] or [{"connectionId": connection_in}]
    outs = [{"signalId": s} for s in sinks] or [{"connectionId": connection_out}]
    name = sinks[0] if sinks else f"{kind}-{sources[0]}"
    return {"operatorType": kind, "id": name, "signals": {"sources": ins, "sinks": outs}, "options": options}


def cols(*pairs):
    return {"cols": [{"from": a, "name": b} for a, b in pairs]}


def flagship(data):
    """Orders joined to customers, timestamped, reduced to the freshest row per customer."""
    return {
        "connections": [connection("orders", f"{data}/orders.parquet"), connection("customers", f"{data}/customer.parquet")],
        "operations": [
            op("reader", [], ["orders"], "orders", expr="o_orderstatus <> 'P'"),
            op("reader", [], ["customers"], "customers", projection=cols(("c_custkey", "custkey"), ("c_name", "name"))),
            op(
                "project",
                ["orders"],
                ["slim"],
                projection=cols(("o_custkey", "custkey"), ("o_orderkey", "orderkey"), ("o_orderdate", "ordered"), ("o_totalprice", "price")),
            ),
            op("join", ["slim", "customers"], ["joined"], cols=["custkey"], joinType="inner"),
            op("filter", ["joined"], ["large"], expr="price > 1000"),
            op(
                "withColumns",
                ["large"],
                ["timed"],
                cols=[
                    {"name": "serial", "expr": "greatest(ordered, timestamp_ntz'1996-01-01')"},
                    {"name": "label", "expr": "concat_ws('-', name, date_format(serial, 'yyyyMMdd'))"},
                ],
            ),
            op("freshestRows", ["timed"], ["fresh"], keyCols=["custkey"], timestamp="serial"),
            op("select", ["fresh"], ["result"], cols=["custkey", "orderkey", "label"]),
        ],
    }


FLAGSHIP = """SELECT custkey, orderkey, c_name || '-' || strftime(serial, '%Y%m%d') AS label FROM (SELECT o_custkey AS custkey,
  o_orderkey AS orderkey, c_name, greatest(o_orderdate, TIMESTAMP '1996-01-01') AS serial,
  max(greatest(o_orderdate, TIMESTAMP '1996-01-01')) OVER (PARTITION BY o_custkey) AS best
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND o_totalprice > 1000) WHERE serial = best"""


@query("flow_build", FLAGSHIP)
def flow_build(spark, data):
    return flow.build_flow(spark, flagship(data), "result")


@query(
    "flow_build_v1",
    """SELECT id, n_name AS nation FROM (SELECT c_custkey AS id, c_nationkey AS nationkey FROM customer WHERE c_acctbal > 0
         UNION ALL SELECT s_suppkey, s_nationkey FROM supplier) JOIN nation ON nationkey = n_nationkey""",
)
def flow_build_v1(spark, data):
    """The older dialect: named operations, nested and listed sources."""
    spec = {
        "connections": [
            connection("customers", f"{data}/customer.parquet"),
            connection("suppliers", f"{data}/supplier.parquet"),
            connection("nations", f"{data}/nation.parquet"),
        ],
        "flows": [
            {"name": "nations", "type": "reader", "connection": "nations", "projection": cols(("n_nationkey", "nationkey"), ("n_name", "nation"))},
            {
                "name": "parties",
                "type": "union",
                "source": [
                    {
                        "type": "project",
                        "source": {"type": "filter", "expr": "c_acctbal > 0", "source": {"type": "reader", "connection": "customers"}},
                        "projection": cols(("c_custkey", "id"), ("c_nationkey", "nationkey")),
                    },
                    {"type": "project", "source": {"type": "reader", "connection": "suppliers"}, "projection": cols(("s_suppkey", "id"), ("s_nationkey", "nationkey"))},
                ],
            },
            {"name": "joined", "type": "join", "source": ["parties", "nations"], "cols": ["nationkey"]},
            {"name": "result", "type": "select", "source": "joined", "cols": ["id", "nation"]},
        ],
    }
    return flow.build_flow(spark, spec, "result")


SCRIPT = """
def initial(context, row):
    row["initial"] = context["mark"] + row["p_brand"][-1]
    return row
"""


@query(
    "flow_operators",
    """WITH l AS (SELECT l_partkey AS partkey, l_orderkey, l_returnflag, l_shipdate AS ts FROM lineitem),
       d AS (SELECT partkey, l_orderkey, l_returnflag, min(ts) AS ts FROM l GROUP BY ALL),
       s AS (SELECT partkey, count(*) AS orders, max(ts) AS latest FROM d WHERE l_returnflag = 'R' GROUP BY partkey)
       SELECT part_id, orders, CAST(latest AS VARCHAR) AS latest, '#' || right(p_brand, 1) AS initial FROM
       (SELECT partkey AS part_id, orders, latest, p_brand FROM s JOIN part ON partkey = p_partkey) ORDER BY part_id LIMIT 500""",
)
def flow_operators(spark, data):
    """Every shaping operator of a flow in one chain."""
    spec = {
        "connections": [connection("lines", f"{data}/lineitem.parquet"), connection("parts", f"{data}/part.parquet")],
        "operations": [
            op("reader", [], ["raw"], "lines", projection=cols(("l_partkey", "partkey"), ("l_orderkey", "l_orderkey"), ("l_returnflag", "l_returnflag"), ("l_shipdate", "ts"))),
            op("deDup", ["raw"], ["once"], eventTimestamp="ts"),
            op("split", ["once"], ["returned", "kept"], expr="l_returnflag = 'R'"),
            op("dropColumns", ["returned"], ["narrow"], cols=["l_returnflag"]),
            op("pushStruct", ["narrow"], ["nested"], cols=["l_orderkey", "ts"], colName="rows", asArray="true"),
            op(
                "withColumn",
                ["nested"],
                ["counted"],
                cols=[{"name": "orders", "expr": "CAST(size(rows) AS BIGINT)"}, {"name": "latest", "expr": "array_max(rows.ts)"}],
            ),
            op("dropColumns", ["counted"], ["facts"], cols=["rows"]),
            op("reader", [], ["parts"], "parts", projection=cols(("p_partkey", "partkey"), ("p_brand", "p_brand"))),
            op("join", ["facts", "parts"], ["joined"], cols=["partkey"]),
            op("withColumnRenamed", ["joined"], ["renamed"], **{"from": "partkey", "to": "part_id"}),
            op("withColumn", ["renamed"], ["text"], col="latest", expr="CAST(latest AS STRING)"),
            op(
                "ruleScript",
                ["text"],
                ["ruled"],
                methodNames=["initial"],
                schema="part_id bigint, orders bigint, latest string, initial string",
                context={"mark": "#"},
            ),
            op("sort", ["ruled"], ["sorted"], expr="part_id"),
            op("limit", ["sorted"], ["first"], rows="500"),
            op("select", ["first"], ["result"], cols=["part_id", "orders", "latest", "initial"]),
        ],
    }
    funcs = {"initial": load_functions(SCRIPT, ["initial"])[0]}
    return flow.build_flow(spark, spec, "result", funcs)


@query("flow_rule_script", "SELECT p_partkey, p_brand, '#' || right(p_brand, 1) AS initial FROM part")
def flow_rule_script(spark, data):
    """A flow that carries the script of its rules."""
    script = base64.b64encode(SCRIPT.encode()).decode()
    schema = "p_partkey bigint, p_brand string, initial string"
    spec = {
        "connections": [connection("parts", f"{data}/part.parquet")],
        "operations": [
            op("reader", [], ["parts"], "parts"),
            op("ruleScript", ["parts"], ["ruled"], methodNames=["initial"], base64Script=script, schema=schema, context={"mark": "#"}),
            op("select", ["ruled"], ["result"], cols=["p_partkey", "p_brand", "initial"]),
        ],
    }
    return flow.build_flow(spark, spec, "result")


@query(
    "flow_push_array_parts",
    "SELECT l_returnflag, count(*) AS n, sum(l_orderkey)::BIGINT AS orders, true AS bounded FROM lineitem GROUP BY 1",
)
def flow_push_array_parts(spark, data):
    """A list of very many rows in numbered parts, which together hold every row."""
    spec = {
        "connections": [connection("lines", f"{data}/lineitem.parquet")],
        "operations": [
            op("reader", [], ["lines"], "lines", projection=cols(*[(c, c) for c in ("l_returnflag", "l_orderkey", "l_linenumber")])),
            op("pushStruct", ["lines"], ["nested"], cols=["l_orderkey", "l_linenumber"], colName="rows", asArray="true", maxItems="500"),
        ],
    }
    nested = flow.build_flow(spark, spec, "nested")
    total = F.sum(F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, x: a + x["l_orderkey"]))
    return nested.groupBy("l_returnflag").agg(
        F.sum(F.size("rows")).alias("n"), total.alias("orders"), (F.max(F.size("rows")) < 1000).alias("bounded")
    )


@query(
    "flow_events",
    """SELECT orderkey, CAST(event_ts AS VARCHAR) AS event_ts, l_linenumber FROM (SELECT o_orderkey AS orderkey,
         greatest(o_orderdate, l_shipdate) AS event_ts, l_linenumber, row_number() OVER (PARTITION BY o_orderkey,
         greatest(o_orderdate, l_shipdate) ORDER BY l_shipdate DESC, o_orderdate DESC, l_linenumber DESC) AS rn
         FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE rn = 1""",
)
def flow_events(spark, data):
    """A flow that joins two timestamped tables to events."""
    spec = {
        "connections": [connection("orders", f"{data}/orders.parquet"), connection("lines", f"{data}/lineitem.parquet")],
        "operations": [
            op("reader", [], ["orders"], "orders", projection=cols(("o_orderkey", "orderkey"), ("o_orderdate", "o_orderdate"))),
            op("reader", [], ["lines"], "lines", projection=cols(("l_orderkey", "orderkey"), ("l_shipdate", "l_shipdate"), ("l_linenumber", "l_linenumber"))),
            op(
                "joinToEvents",
                ["orders", "lines"],
                ["events"],
                cols=["orderkey"],
                keyCols=["orderkey"],
                timestamp_a="o_orderdate",
                timestamp_b="l_shipdate",
                eventTimestamp="event_ts",
            ),
            op("withColumn", ["events"], ["text"], col="event_ts", expr="CAST(event_ts AS STRING)"),
            op("select", ["text"], ["result"], cols=["orderkey", "event_ts", "l_linenumber"]),
        ],
    }
    return flow.build_flow(spark, spec, "result")


def sink_spec(data, targets):
    """A flow with a tee and a split, and a sink behind each branch."""
    return {
        "connections": [
            connection("orders", f"{data}/orders.parquet"),
            *[connection(n, p, "ORC" if n == "open" else "PARQUET") for n, p in targets.items()],
        ],
        "operations": [
            op("reader", [], ["orders"], "orders", projection=cols(("o_orderkey", "o_orderkey"), ("o_orderstatus", "o_orderstatus"))),
            op("tee", ["orders"], ["all", "more"]),
            op("split", ["more"], ["closed", "open"], expr="o_orderstatus = 'F'"),
            op("writer", ["all"], [], connection_out="all"),
            op("writer", ["closed"], [], connection_out="closed"),
            op("sink", ["open"], [], connection_out="open"),
        ],
    }


FLOW_RUN = """SELECT 'all' AS target, o_orderkey, o_orderstatus FROM orders
  UNION ALL SELECT 'closed', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'open', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'"""


def read_targets(spark, targets):
    out = None
    for name, path in targets.items():
        df = spark.read.format("orc" if name == "open" else "parquet").load(path)
        df = df.select(F.lit(name).alias("target"), "o_orderkey", "o_orderstatus")
        out = df if out is None else out.unionByName(df)
    return out


@query("flow_run", FLOW_RUN)
def flow_run(spark, data):
    """All sinks are written, the shared rows computed once."""
    targets = {n: scratch_dir(spark, n) for n in ("all", "closed", "open")}
    flow.run_flow(spark, sink_spec(data, targets))
    return read_targets(spark, targets)


@query("flow_run_side_sinks", FLOW_RUN)
def flow_run_side_sinks(spark, data):
    """Running one sink fires the sinks on the other branches of its tee and split."""
    targets = {n: scratch_dir(spark, n) for n in ("all", "closed", "open")}
    flow.run_flow(spark, sink_spec(data, targets), "writer-closed")
    return read_targets(spark, targets)


@query("flow_preview", "SELECT (SELECT count(*) FROM orders) AS orders, 20::BIGINT AS shown, 3::BIGINT AS columns, count(*) AS counted FROM (" + FLAGSHIP + ")")
def flow_preview(spark, data):
    """First rows, schema and count of a signal; only those rows reach the driver."""
    seen = flow.preview(spark, flagship(data), "result", n=20, count=True)
    facts = {"shown": len(seen.rows), "columns": len(seen.rows[0]), "counted": seen.count}
    counted = table(spark, data, "orders").agg(F.count("*").alias("orders"))
    return counted.select("orders", *[F.lit(v).cast("bigint").alias(k) for k, v in facts.items()])


@query("sub_flow", "SELECT c_custkey AS id, upper(c_name) AS name FROM customer WHERE c_acctbal > 100")
def sub_flow(spark, data):
    """A flow inside a flow, fed by a signal of the outer one."""
    inner = {
        "operations": [
            op("filter", ["given"], ["rich"], expr="c_acctbal > 100"),
            op("withColumn", ["rich"], ["loud"], col="name", expr="upper(c_name)"),
        ]
    }
    spec = {
        "connections": [connection("customers", f"{data}/customer.parquet")],
        "subFlows": {"shout": inner},
        "operations": [
            op("reader", [], ["customers"], "customers"),
            op("subFlow", ["customers"], ["shouted"], flowName="shout", inputs=["given"], output="loud"),
            op("project", ["shouted"], ["result"], projection=cols(("c_custkey", "id"), ("name", "name"))),
        ],
    }
    return flow.build_flow(spark, spec, "result")


@query(
    "flow_timed_table",
    "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-20'",
)
def flow_timed_table(spark, data):
    spec = {
        "connections": [connection("events", f"{data}/events.parquet")],
        "operations": [
            op("reader", [], ["now"], "events", projection=cols(("event_id", "event_id"), ("user_id", "user_id"), ("ts", "ts"))),
            op("filter", ["now"], ["before"], expr="ts <= timestamp_ntz'2024-01-15'"),
            op("timedTable", ["now", "before"], ["gained"], timestamp="ts", till="2024-01-20"),
            op("select", ["gained"], ["result"], cols=["event_id", "user_id"]),
        ],
    }
    return flow.build_flow(spark, spec, "result")


@query("pull_flow", "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def pull_flow(spark, data):
    """History first, unwritten; then two pulls of what came after."""
    target = scratch_dir(spark, "pulled")
    store = SnapshotStore(spark, scratch_dir(spark, "pull-state"))
    spec = {
        "connections": [connection("events", f"{data}/events.parquet"), connection("out", target)],
        "operations": [
            op("reader", [], ["events"], "events", projection=cols(("event_id", "event_id"), ("user_id", "user_id"), ("ts", "ts"))),
            op("writer", ["events"], [], connection_out="out", prefetch={"save": "false"}),
        ],
    }
    days = ["2024-01-10", "2024-01-20", "2024-02-01"]
    for batch, day in enumerate(days):
        flow.pull_flow(spark, spec, "writer-events", store, batch, "ts", day)
    return spark.read.parquet(target).select("event_id", "user_id")


def pulled_flow(data, *operations):
    """Orders and lines with the times they came at, and what a test flow makes of them."""
    return {
        "connections": [connection("orders", f"{data}/orders.parquet"), connection("lines", f"{data}/lineitem.parquet")],
        "operations": [
            op("reader", [], ["orders"], "orders", projection=cols(("o_orderkey", "orderkey"), ("o_custkey", "custkey"), ("o_orderdate", "ordered"), ("o_totalprice", "price")), timestamp="ordered"),
            op("reader", [], ["lines"], "lines", projection=cols(("l_orderkey", "orderkey"), ("l_linenumber", "line"), ("l_shipdate", "shipped"), ("l_quantity", "quantity")), timestamp="shipped"),
            *operations,
        ],
    }


SINCE, UNTIL = "1997-03-01 00:00:00", "1998-03-01 00:00:00"


def _gained(rows):
    """SQL for the rows of a query over what had come by `till` that it lacked before."""
    return f"SELECT * FROM ({rows.format(till=UNTIL)}) EXCEPT ALL SELECT * FROM ({rows.format(till=SINCE)})"


PULL_JOIN = """SELECT o_orderkey AS orderkey, o_custkey AS custkey, l_linenumber AS line FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE o_orderdate <= TIMESTAMP '{till}' AND l_shipdate <= TIMESTAMP '{till}' AND l_quantity > 10"""


@query("pull_flow_join", _gained(PULL_JOIN))
def pull_flow_join(spark, data):
    """Rows an inner join gained: new orders with all lines, and old orders with new lines."""
    spec = pulled_flow(
        data,
        op("filter", ["lines"], ["large"], expr="quantity > 10"),
        op("join", ["orders", "large"], ["joined"], cols=["orderkey"]),
        op("select", ["joined"], ["result"], cols=["orderkey", "custkey", "line"]),
    )
    return delta.flow_changes(spark, spec, "result", SINCE, UNTIL).gained


PULL_UNION = """SELECT o_orderkey AS orderkey, 'order' AS kind, CAST(o_orderdate AS VARCHAR) AS at FROM orders WHERE o_orderdate <= TIMESTAMP '{till}'
  UNION ALL SELECT l_orderkey, 'line', CAST(l_shipdate AS VARCHAR) FROM lineitem WHERE l_shipdate <= TIMESTAMP '{till}'"""


@query("pull_flow_union", _gained(PULL_UNION))
def pull_flow_union(spark, data):
    spec = pulled_flow(
        data,
        op("withColumns", ["orders"], ["a"], cols=[{"name": "kind", "expr": "'order'"}, {"name": "at", "expr": "CAST(ordered AS STRING)"}]),
        op("withColumns", ["lines"], ["b"], cols=[{"name": "kind", "expr": "'line'"}, {"name": "at", "expr": "CAST(shipped AS STRING)"}]),
        op("select", ["a"], ["left"], cols=["orderkey", "kind", "at"]),
        op("select", ["b"], ["right"], cols=["orderkey", "kind", "at"]),
        op("union", ["left", "right"], ["result"]),
    )
    return delta.flow_changes(spark, spec, "result", SINCE, UNTIL).gained


PULL_FRESHEST = """SELECT custkey, orderkey, line FROM (SELECT o_custkey AS custkey, o_orderkey AS orderkey, l_linenumber AS line,
    greatest(o_orderdate, l_shipdate) AS moment, max(greatest(o_orderdate, l_shipdate)) OVER (PARTITION BY o_custkey) AS best
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate <= TIMESTAMP '{till}' AND l_shipdate <= TIMESTAMP '{till}') WHERE moment = best"""


def freshest_flow(data):
    return pulled_flow(
        data,
        op("join", ["orders", "lines"], ["joined"], cols=["orderkey"]),
        op("withColumn", ["joined"], ["timed"], col="moment", expr="greatest(ordered, shipped)"),
        op("freshestRows", ["timed"], ["fresh"], keyCols=["custkey"], timestamp="moment"),
        op("select", ["fresh"], ["result"], cols=["custkey", "orderkey", "line"]),
    )


@query("pull_flow_freshest", _gained(PULL_FRESHEST))
def pull_flow_freshest(spark, data):
    """The freshest rows of customers that something new came for."""
    return delta.flow_changes(spark, freshest_flow(data), "result", SINCE, UNTIL).gained


@query(
    "pull_flow_lost",
    "SELECT * FROM (" + PULL_FRESHEST.format(till=SINCE) + ") EXCEPT ALL SELECT * FROM (" + PULL_FRESHEST.format(till=UNTIL) + ")",
)
def pull_flow_lost(spark, data):
    """The rows that were the freshest, and are no longer."""
    return delta.flow_changes(spark, freshest_flow(data), "result", SINCE, UNTIL).lost


PULL_OUTER = """SELECT o_orderkey AS orderkey, count(l_linenumber) AS lines FROM (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{till}')
  LEFT JOIN (SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '{till}') ON o_orderkey = l_orderkey GROUP BY 1"""


@query("pull_flow_nested", _gained(PULL_OUTER))
def pull_flow_nested(spark, data):
    """Lists of an order's lines, through an outer join; orders whose list changed come again."""
    spec = pulled_flow(
        data,
        op("select", ["orders"], ["heads"], cols=["orderkey"]),
        op("join", ["heads", "lines"], ["joined"], cols=["orderkey"], joinType="left"),
        op("pushStruct", ["joined"], ["nested"], cols=["line", "shipped", "quantity"], colName="rows", asArray="true"),
        op("withColumn", ["nested"], ["counted"], col="lines", expr="CAST(size(filter(rows, r -> r.line IS NOT NULL)) AS BIGINT)"),
        op("select", ["counted"], ["result"], cols=["orderkey", "lines"]),
    )
    return delta.flow_changes(spark, spec, "result", SINCE, UNTIL).gained


@query(
    "flow_catch_up",
    """SELECT event_id, CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10')) / (5 * 86400000000)) AS INT) AS batch_id
       FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-28 12:00:00'""",
)
def flow_catch_up(spark, data):
    """History unwritten, then five days at a time up to now; the second call has nothing left to do."""
    target, state = scratch_dir(spark, "caught-up"), scratch_dir(spark, "catch-up-state")
    spec = {
        "connections": [connection("events", f"{data}/events.parquet"), connection("out", target)],
        "operations": [
            op("reader", [], ["events"], "events", timestamp="ts"),
            op("writer", ["events"], [], connection_out="out", prefetch={"to": "2024-01-10 00:00:00", "save": "false"}, catchupIncrement="5 days"),
        ],
    }
    for now in ("2024-01-25 00:00:00", "2024-01-28 12:00:00", "2024-01-28 12:00:00"):
        delta.catch_up_flow(spark, spec, "writer-events", state, now)
    return spark.read.parquet(target).select("event_id", "batch_id")
