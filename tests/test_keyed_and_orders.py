import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowframe.functions import bizdays as bd
from flowframe.functions.timestamps import check_pattern, parse_timestamp_any
from flowframe.operators import cells, intervals, orders, validate
from flowframe.operators.hierarchy import hierarchy_root
from flowframe.operators.orders import classify_group
from tests.helpers import rows


def log(spark):
    data = [("r1", "f", "a", 1, "old"), ("r1", "f", "a", 3, "new"), ("r1", "f", "b", 2, "x"), ("r2", "f", "b", 3, "y"), ("r2", "g", "a", 9, "z"), ("r1", "f", "a", 3, "new")]
    return spark.createDataFrame(data, "row_key string, family string, qualifier string, ts long, value string")


def test_cells_latest_versions_and_ranges(spark):
    assert rows(cells.cells_latest(log(spark), ["a", "b"], "f")) == [("r1", "new", "x"), ("r2", None, "y")]
    assert rows(cells.cells_versions(log(spark), ["a", "b"], 2, "f")) == [("r1", 1, "old", None), ("r1", 2, None, "x"), ("r1", 3, "new", None), ("r2", 3, None, "y")]
    assert rows(cells.cells_versions(log(spark), ["a"], 1, "f"), "row_key", "ts") == [("r1", 3)]
    assert rows(cells.cells_between(log(spark), 2, 3), "value") == [("x",)]
    with pytest.raises(ValueError):
        cells.cells_in(log(spark), at=1, low=0, high=2)
    with pytest.raises(ValueError):
        cells.cells_in(log(spark), low=0)


def test_lookback_skips_only_recent_hashes(spark):
    history = spark.createDataFrame([("k", 1, "h1"), ("k", 2, "h2"), ("k", 3, "h3")], "row_key string, ts long, dedup_key string")
    batch = spark.createDataFrame([("k", "h1"), ("k", "h3"), ("k", ""), ("other", "h3")], "row_key string, dedup_key string")
    assert rows(cells.upsert_with_lookback(history, batch, 2)) == [("k", ""), ("k", "h1"), ("other", "h3")]


def test_hierarchy_reports_circles_and_orphans(spark):
    data = [("o", "10", "000000"), ("o", "20", "10"), ("o", "30", "20"), ("o", "40", "99"), ("o", "50", "60"), ("o", "60", "50"), ("o", "70", "60"), ("p", "20", "10"), ("o", "80", None)]
    df = spark.createDataFrame(data, "g string, item string, parent string")
    got = {(r["g"], r["item"]): r["root"] for r in hierarchy_root(df, ["g"], "item", "parent").collect()}
    assert got == {
        ("o", "10"): "10", ("o", "20"): "10", ("o", "30"): "10", ("o", "40"): "n/a", ("o", "50"): "cycle",
        ("o", "60"): "cycle", ("o", "70"): "cycle", ("p", "20"): "n/a", ("o", "80"): "n/a",
    }


def test_hierarchy_deeper_than_any_recursion_limit(spark):
    df = spark.range(1, 400).selectExpr("'g' AS g", "CAST(id AS STRING) AS item", "CASE WHEN id = 1 THEN '000000' ELSE CAST(id - 1 AS STRING) END AS parent")
    assert rows(hierarchy_root(df, ["g"], "item", "parent").groupBy("root").count()) == [("1", 399)]


def test_assembled_lists_are_empty_not_null_and_do_not_multiply(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    a = spark.createDataFrame([(1, "x"), (1, "y")], "id int, a string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (1, "r")], "id int, b string")
    out = orders.assemble(parent, {"as": (a, ["id"], ["a"]), "bs": (b, ["id"], ["b"])})
    assert {r["id"]: (len(r["as"]), len(r["bs"])) for r in out.collect()} == {1: (2, 3), 2: (0, 0)}


def test_rules_are_the_callers_data(spark):
    lines = [(1, 1, "a", 5), (1, 2, "b", 50), (2, 1, "a", 70), (3, 1, None, None)]
    df = spark.createDataFrame(lines, "o int, n int, kind string, size int")
    facts = {"has_b": "kind = 'b'", "has_big": F.col("size") > 40}
    labels = [("mixed", "has_b AND kind = 'a'"), ("big", F.col("has_big")), ("several", "line_count > 1")]
    got = dict(rows(classify_group(df.filter("n = 1"), df, ["o"], facts, labels, "plain", "label"), "o", "label"))
    assert got == {1: "mixed", 2: "big", 3: "plain"}


def test_every_row_has_a_root(spark):
    data = [(None, "1", "000000"), (None, "2", "1"), ("g", None, "1"), ("g", "1", None)]
    df = spark.createDataFrame(data, "g string, item string, parent string")
    assert rows(hierarchy_root(df, ["g"], "item", "parent"), "g", "item", "root") == [
        (None, "1", "1"), (None, "2", "1"), ("g", None, "n/a"), ("g", "1", "n/a")
    ]


def test_lines_of_unknown_systems_have_no_date(spark):
    df = spark.createDataFrame(
        [("i", "999", "Hub", 1, "20200101", "20200101000000", "1", "")],
        "item string, client string, flowtype string, schedulelineconfirmedqty int, plannedfactoryshipdate string, serial string, schedulelinenum string, atpserial string",
    )
    found = intervals.schedule_commit_dates(df, ["item"], "2020-01-02", hub_flows=["Hub"], newer=["300"], older=["010"])
    assert found.count() == 0


def test_status_interval_is_closed_by_the_next_change(spark):
    data = [("o", "header", "H1", "001", None, "t1"), ("o", "header", "H1", "002", "X", "t2"), ("o", "header", "H1", "003", None, "t3"), ("o", "item", "H1", "002", "X", "t9")]
    df = spark.createDataFrame(data, "id string, statustype string, objectstatuscode string, objectchangenum string, objectinactive string, starttime string")
    assert rows(intervals.status_intervals(df, ["id"]), "changenum", "starttime", "endtime") == [(1, "t1", "t2"), (3, "t3", "")]


def test_milestones_end_where_the_next_starts(spark):
    df = spark.createDataFrame([("o", "1", None, "3", "")], "id string, a string, b string, c string, d string")
    out = intervals.milestone_chain(df, ["id"], [(1, "a", F.col("a")), (2, "b", F.col("b")), (3, "c", F.col("c")), (4, "d", F.col("d"))])
    assert rows(out, "seq", "milestone", "starttime", "endtime") == [(1, "a", "1", "3"), (3, "c", "3", "")]


def step_days(day, n, direction):
    while n > 0:
        day += dt.timedelta(days=direction)
        n -= day.isoweekday() <= 5
    return day


def test_working_days_match_stepping(spark):
    rng = random.Random(3)
    start = dt.date(2019, 12, 1)
    data = [(start + dt.timedelta(days=i), rng.randint(-1, 30)) for i in range(400)]
    df = spark.createDataFrame(data, "d date, n int")
    d, n = F.col("d"), F.col("n")
    got = df.select("d", "n", bd.add_workdays(d, n).alias("a"), bd.subtract_workdays(d, n).alias("s"), bd.workdays_between(d, F.date_add(d, n)).alias("b")).collect()
    for r in got:
        assert r["a"] == step_days(r["d"], r["n"], 1) and r["s"] == step_days(r["d"], r["n"], -1)
        between = sum((r["d"] + dt.timedelta(days=i)).isoweekday() <= 5 for i in range(max(r["n"], 0)))
        assert r["b"] == between


def test_quarter_ends(spark):
    days = {"2020-11-15": "2021-01-29", "2020-01-31": "2020-01-31", "2020-03-01": "2020-04-30", "2020-10-31": "2020-10-30", "2020-08-02": "2020-10-30"}
    df = spark.createDataFrame([(k,) for k in days], "s string").select("s", bd.last_workday_of_quarter(bd.parse_day(F.col("s"))).cast("string").alias("x"))
    assert dict(rows(df)) == days


def test_timestamps_in_every_accepted_form(spark):
    texts = {
        "03/04/2021 05:06": "2021-04-03T10:06:00.000Z",
        "2021-04-03T05:06:07Z": "2021-04-03T05:06:07.000Z",
        "2021-04-03T05:06:07.25+02:00": "2021-04-03T03:06:07.250Z",
        "2021-04-03T05:06:07+02:00[Europe/Paris]": "2021-04-03T03:06:07.000Z",
        "2021-04-03T05:06": "2021-04-03T10:06:00.000Z",
        "2021-04-03": "2021-04-03T05:00:00.000Z",
        "nonsense": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_timestamp_any(F.col("t"), "dd/MM/yyyy HH:mm", "-05:00").alias("p"))
    got = {r["t"]: r["p"] for r in df.collect()}
    assert {t: p["ts"] for t, p in got.items()} == texts
    assert "no timestamp in nonsense" in got["nonsense"]["error"] and got["2021-04-03"]["error"] == ""


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("03/04/2021 05:06",)], "t string")
        assert df.select(parse_timestamp_any(F.col("t"), "dd/MM/yyyy HH:mm", "America/New_York")["ts"]).first()[0] == "2021-04-03T09:06:00.000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_pattern_is_refused():
    with pytest.raises(ValueError):
        check_pattern("yyyy-bb")


def test_field_rules(spark):
    df = spark.sql("SELECT 'o1' AS id, '12' AS qty, CAST(NULL AS STRING) AS gone, array(named_struct('code', 'A1', 'x', '1'), named_struct('code', 'b', 'x', CAST(NULL AS STRING))) AS lines")
    out = validate.validate_fields(df, {"id": "^o", "qty": "^[0-9]$", "lines.code": "[A-Z]"}, ["id"])
    assert rows(out) == [("o1", "lines.code", "b", "InvalidFormat"), ("o1", "lines.x", "1", "MissingMapping"), ("o1", "qty", "12", "InvalidFormat")]


def test_latest_values_are_those_of_lists(spark):
    from pyspark.sql import functions as F

    from flowframe.operators import intervals

    lines = spark.createDataFrame([(1, "a", "2", "x"), (1, "a", "3", "y"), (1, "a", "3", "z"), (1, "b", "9", "w"), (2, "b", None, "v"), (None, "a", "1", "u")], "k int, kind string, o string, v string")
    got = {r["k"]: (r["a"], r["c"]) for r in intervals.latest_values(lines, ["k"], "o", "v", {"a": "kind = 'a'", "c": "kind = 'c'"}).collect()}
    assert got == {1: ("z", ""), 2: ("", ""), None: ("u", "")}
    lists = lines.groupBy("k").agg(F.collect_list(F.struct("kind", "o", "v")).alias("e"))
    assert {r["k"]: r["a"] for r in lists.select("k", intervals.latest_entry(F.col("e"), lambda e: e["kind"] == "a", "o", "v").alias("a")).collect()} == {k: a for k, (a, _) in got.items()}


def test_tables_of_a_mapping():
    from flowframe.operators import mapping

    spec = {"templates": [{"name": "a", "row": {"name": "T"}}, {"name": "b", "rows": [{"tableName": "U", "rowkey": "x"}, {"name": "T"}]}, {"name": "c"}]}
    assert mapping.target_tables(spec) == ["T", "U"]


def test_lists_are_sorted_without_a_comparator(spark):
    """Lists are in the order of their structs, nulls first, and no comparing expression is run for each pair."""
    from flowframe.operators.nesting import nested_lists

    df = spark.createDataFrame([(1, "b", 2), (1, None, 3), (1, "b", None), (1, "a", 1)], "k int, x string, y int")
    for most in (None, 10):
        lists = nested_lists(df, ["k"], ["x", "y"], "l", most)
        assert "lambda" not in lists._jdf.queryExecution().executedPlan().toString()
        assert [tuple(e) for e in lists.first()["l"]] == [(None, 3), ("a", 1), ("b", None), ("b", 2)]
