"""Changes of flows against whole results before and after."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowframe.catalog.flows import connection, op
from flowframe.operators.incremental import SnapshotStore
from flowframe.plans import delta, flow

SINCE, TILL = "2024-01-10", "2024-01-20"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two small tables with repeated rows, null keys and null times."""
    root, r = tmp_path_factory.mktemp("changes"), random.Random(4)
    for name in ("a", "b"):
        rows = [
            (r.choice([1, 2, 3, 4, 5, 6, None]), r.choice("xyz"), r.choice([1, 2, 3]), r.choice([f"2024-01-{d:02}" for d in range(1, 25)] + [None]))
            for _ in range(60)
        ]
        df = spark.createDataFrame(rows + rows[:6], f"k int, {name}_text string, {name}_n int, {name}_at string")
        df.coalesce(1).write.parquet(f"{root}/{name}")
    return str(root)


def spec(root, *operations):
    return {
        "connections": [connection("a", f"{root}/a"), connection("b", f"{root}/b")],
        "operations": [
            op("reader", [], ["a"], "a", timestamp="a_at"),
            op("reader", [], ["b"], "b", timestamp="b_at"),
            *operations,
        ],
    }


def bag(df):
    return Counter(str(sorted(r.asDict(True).items())) for r in df.collect())


FRESH = op("freshestRows", ["a"], ["fresh"], keyCols=["k"], timestamp="a_at")
CASES = {
    "row by row": [
        op("filter", ["a"], ["f"], expr="a_n > 1"),
        op("withColumn", ["f"], ["w"], col="twice", expr="a_n * 2"),
        op("pushStruct", ["w"], ["p"], cols=["a_n", "twice"], colName="s"),
        op("popStruct", ["p"], ["q"], col="s", keepRest="true"),
        op("withColumnRenamed", ["q"], ["result"], **{"from": "k", "to": "key"}),
    ],
    "inner join": [op("join", ["a", "b"], ["result"], cols=["k"])],
    "join of what may be lost": [FRESH, op("join", ["fresh", "b"], ["result"], cols=["k"])],
    "both sides lose": [
        FRESH,
        op("deDup", ["b"], ["once"], eventTimestamp="b_at"),
        op("join", ["fresh", "once"], ["j"], cols=["k"]),
        op("select", ["j"], ["result"], cols=["k", "a_text"]),
    ],
    "left join": [op("join", ["a", "b"], ["result"], cols=["k"], joinType="left")],
    "full join": [op("join", ["a", "b"], ["result"], cols=["k"], joinType="full")],
    "anti join": [op("join", ["a", "b"], ["result"], cols=["k"], joinType="left_anti")],
    "union": [
        FRESH,
        op("project", ["fresh"], ["x"], projection={"cols": [{"from": "k", "name": "k"}, {"from": "a_text", "name": "t"}]}),
        op("project", ["b"], ["y"], projection={"cols": [{"from": "k", "name": "k"}, {"from": "b_text", "name": "t"}]}),
        op("union", ["x", "y"], ["one"]),
        op("union", ["y", "x"], ["two"]),
        op("union", ["one", "two"], ["result"]),
    ],
    "de-duplication": [op("deDup", ["a"], ["d"], eventTimestamp="a_at", ignorableCols=["a_n"]), op("select", ["d"], ["result"], cols=["k", "a_text", "a_at"])],
    "events": [
        op("joinToEvents", ["a", "b"], ["result"], cols=["k"], keyCols=["k"], timestamp_a="a_at", timestamp_b="b_at", eventTimestamp="at"),
    ],
    "nested lists": [op("pushStruct", ["a"], ["n"], cols=["a_n", "a_at"], colName="rows", asArray="true"), op("withColumn", ["n"], ["result"], col="rows", expr="array_sort(rows)")],
    "split": [op("split", ["a"], ["high", "low"], expr="a_n > 2"), op("union", ["low", "high"], ["result"])],
    "distinct split": [op("split", ["a"], ["high", "result"], expr="a_n > 2", distinct="true")],
    "a window over other rows": [op("withColumn", ["a"], ["result"], col="m", expr="max(a_n) over (partition by k)")],
    "sub-flow": [
        op(
            "subFlow", ["a", "b"], ["result"], inputs=["l", "r"], output="out",
            flow={"operations": [op("freshestRows", ["l"], ["m"], keyCols=["k"], timestamp="a_at"), op("join", ["m", "r"], ["out"], cols=["k"])]},
        )
    ],
    "tee and sort": [op("tee", ["a"], ["s", "t"]), op("sort", ["t"], ["result"], expr="a_at")],
}


@pytest.mark.parametrize("name", CASES)
def test_changes_are_those_of_whole_results(spark, tables, name):
    given = spec(tables, *CASES[name])
    known = lambda till: [
        op("filter", ["a0"], ["a"], expr=f"coalesce(a_at <= '{till}', true)"),
        op("filter", ["b0"], ["b"], expr=f"coalesce(b_at <= '{till}', true)"),
    ]
    whole = lambda till: {**given, "operations": [op("reader", [], ["a0"], "a"), op("reader", [], ["b0"], "b"), *known(till), *CASES[name]]}
    old, new = bag(flow.build_flow(spark, whole(SINCE), "result")), bag(flow.build_flow(spark, whole(TILL), "result"))
    got = delta.flow_changes(spark, given, "result", SINCE, TILL)
    assert bag(got.before) == old
    assert bag(got.gained) == new - old
    assert (Counter() if got.lost is None else bag(got.lost)) == old - new
    assert new - old


def test_old_months_are_not_read(spark, tmp_path):
    """What is new is found without the directories of earlier months, through joins and unions too."""
    days = spark.range(200).select(F.col("id"), F.expr("date_add(date'2024-01-01', CAST(id AS INT))").cast("string").alias("at"))
    days.withColumn("yearmonth", F.expr("replace(substring(at, 1, 7), '-', '')")).write.partitionBy("yearmonth").parquet(f"{tmp_path}/days")
    given = {
        "connections": [connection("days", f"{tmp_path}/days")],
        "operations": [
            op("reader", [], ["days"], "days", timestamp="at", monthCol="yearmonth"),
            op("filter", ["days"], ["even"], expr="id % 2 = 0"),
            op("filter", ["days"], ["odd"], expr="id % 2 = 1"),
            op("union", ["even", "odd"], ["result"]),
        ],
    }
    got = delta.flow_changes(spark, given, "result", "2024-05-10", "2024-06-15")
    assert got.lost is None and got.gained.count() == 36
    files = got.gained.select(F.input_file_name()).distinct().collect()
    assert {f[0].split("yearmonth=")[1][:6] for f in files} == {"202405", "202406"}
    plan = got.gained._jdf.queryExecution().executedPlan().toString()
    assert "202405" in plan.split("PartitionFilters")[1]


def test_pulls_write_what_is_new(spark, tables, tmp_path):
    given = spec(tables, FRESH, op("writer", ["fresh"], [], connection_out="out"))
    given["connections"].append(connection("out", f"{tmp_path}/out"))
    store = SnapshotStore(spark, f"{tmp_path}/state")
    assert delta.pull_changes(spark, given, "writer-fresh", store, 0, None, SINCE).count() > 0
    want = bag(delta.flow_changes(spark, given, "fresh", SINCE, TILL).gained)
    for _ in range(2):  # a pull that is run again replaces itself
        assert bag(delta.pull_changes(spark, given, "writer-fresh", store, 1, SINCE, TILL)) == want
    assert bag(spark.read.parquet(f"{tmp_path}/out").drop("batch_id")) == want
    with pytest.raises(flow.FlowError):
        delta.pull_changes(spark, given, "nobody", store, 2, SINCE, TILL)
    with pytest.raises(flow.FlowError):
        delta.flow_changes(spark, {**given, "operations": [op("reader", [], ["a"], "a")]}, "a", SINCE, TILL)
    told = delta.Delta(*[spark.createDataFrame([(k,)], "k int") for k in (1, 2)])
    assert bag(delta.flow_changes(spark, {**given, "operations": [op("reader", [], ["a"], "a")]}, "a", SINCE, TILL, given={"a": told}).gained) == bag(told.gained)


def test_a_broken_catch_up_goes_on(spark, tmp_path, monkeypatch):
    """A run that breaks between ranges is taken up by the next, which repeats only the open range."""
    rows = [(i, f"2024-01-{d:02} 12:00:00") for i, d in enumerate(range(1, 31))]
    spark.createDataFrame(rows, "id int, at string").write.parquet(f"{tmp_path}/rows")
    given = {
        "connections": [connection("rows", f"{tmp_path}/rows"), connection("out", f"{tmp_path}/out")],
        "operations": [
            op("reader", [], ["rows"], "rows", timestamp="at"),
            op("writer", ["rows"], [], connection_out="out", prefetch={"from": "2024-01-03 00:00:00", "to": "2024-01-11 00:00:00", "save": "true"}, catchupIncrement="7 days"),
        ],
    }
    real, calls = flow.write_sink, []

    def breaking(f, node, df, batch_id=None):
        calls.append(batch_id)
        real(f, node, df, batch_id)
        if batch_id == 2 and calls.count(2) == 1:
            raise OSError("lost")

    monkeypatch.setattr(flow, "write_sink", breaking)
    with pytest.raises(OSError):
        delta.catch_up_flow(spark, given, "writer-rows", f"{tmp_path}/state", "2024-01-27 00:00:00")
    assert delta.catch_up_flow(spark, given, "writer-rows", f"{tmp_path}/state", "2024-01-27 00:00:00") == [2, 3]
    assert delta.catch_up_flow(spark, given, "writer-rows", f"{tmp_path}/state", "2024-01-27 00:00:00") == []
    assert delta.catch_up_flow(spark, given, "writer-rows", f"{tmp_path}/state", "2024-01-29 00:00:00") == [4]
    assert calls == [0, 1, 2, 2, 3, 4]
    got = Counter((r["id"], r["batch_id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == Counter({(d - 1, 0 if d < 11 else 1 if d < 18 else 2 if d < 25 else 3 if d < 27 else 4): 1 for d in range(3, 29)})
    with pytest.raises(flow.FlowError):
        delta.catch_up_flow(spark, {**given, "operations": [given["operations"][0], op("writer", ["rows"], [], connection_out="out")]}, "writer-rows", f"{tmp_path}/s2", "2024-01-27")


def test_ranges(spark):
    assert delta.catch_up_ranges(spark, "2024-01-01", "2024-01-01 00:00:00") == []
    assert delta.catch_up_ranges(spark, "2024-01-02", "2024-01-01") == []
    assert delta.catch_up_ranges(spark, "2024-01-01", "2024-01-03 06:00:00") == [
        ("2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("2024-01-02 00:00:00", "2024-01-03 00:00:00"),
        ("2024-01-03 00:00:00", "2024-01-03 06:00:00"),
    ]
