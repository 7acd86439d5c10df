import random

import pytest
from pyspark.sql import functions as F

from flowframe.operators import events, incremental
from flowframe.operators.windows import ordered_neighbours
from tests.helpers import rows


def test_freshest_rows_keeps_ties_and_text_timestamps(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-02T00:00:00.000Z", 1), ("a", "2020-01-02T00:00:00.000Z", 2), ("a", "2019-01-01T00:00:00.000Z", 3), ("b", "0007", 4)],
        "k string, ts string, v int",
    )
    assert rows(events.freshest_rows(df, ["k"], "ts"), "k", "v") == [("a", 1), ("a", 2), ("b", 4)]


def test_current_state_when_the_key_is_the_timestamp(spark):
    df = spark.createDataFrame([("t1", 1), ("t1", 1), ("t2", 2)], "ts string, v int")
    assert rows(events.current_state(df, ["ts"], "ts")) == [("t1", 1), ("t2", 2)]


def test_dedup_keeps_the_oldest_and_its_ignored_columns(spark):
    df = spark.createDataFrame([(1, "b", "t2", "late"), (1, "b", "t1", "early"), (2, None, "t9", "x"), (2, None, None, "y")], "k int, v string, ts string, note string")
    out = events.dedup_oldest(df, "ts", ignore=["note"])
    assert out.columns == df.columns
    assert rows(out) == [(1, "b", "t1", "early"), (2, None, None, "y")]


def test_dedup_null_timestamp_is_oldest(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 3), (2, 4)], "k int, ts int")
    assert rows(events.dedup_oldest(df, "ts")) == [(1, None), (2, 3)]


def test_copies_are_combined_before_the_shuffle(spark):
    plan = events.dedup_oldest(spark.range(10).selectExpr("id % 2 AS k", "id AS ts"), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_to_events_one_row_or_strict(spark):
    # same event time 9: (l=9, r=3) and (l=3, r=9)
    df = spark.createDataFrame([("k", 9, 3, "p"), ("k", 3, 9, "q"), ("k", 2, 9, "r"), ("k", None, 4, "s")], "k string, l int, r int, v string")
    assert rows(events.to_events(df, ["k"], "l", "r", "e"), "e", "v") == [(4, "s"), (9, "q")]
    assert rows(events.to_events(df, ["k"], "l", "r", "e", strict_compat=True), "e", "v") == [(9, "p"), (9, "q")]


def test_row_limits_apply_on_the_map_side(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS l", "id AS r")
    plan = events.to_events(df, ["k"], "l", "r", "e")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_join_delta_equals_what_the_full_join_gains(spark):
    rng = random.Random(5)
    left = [(rng.randint(0, 5), i) for i in range(40)]
    right = [(rng.randint(0, 5), i) for i in range(40)]
    make = lambda data, name: spark.createDataFrame(data, f"k int, {name} int")
    lv = incremental.TimeView(make(left[:30], "a"), make(left[30:], "a"))
    rv = incremental.TimeView(make(right[:25], "b"), make(right[25:], "b"))
    gained = incremental.join_views(lv, rv, ["k"]).new
    full, old = lv.all.join(rv.all, "k"), lv.previous.join(rv.previous, "k")
    assert rows(gained) == rows(full.exceptAll(old))


def test_delta_when_only_the_right_side_is_new(spark):
    left = incremental.TimeView(spark.createDataFrame([(1, 1)], "k int, a int"), spark.createDataFrame([], "k int, a int"))
    right = incremental.TimeView(spark.createDataFrame([], "k int, b int"), spark.createDataFrame([(1, 2)], "k int, b int"))
    assert rows(incremental.join_views(left, right, ["k"]).new) == [(1, 1, 2)]


def test_new_rows_and_next_snapshot(spark):
    current = spark.createDataFrame([(1, "05"), (2, "06"), (3, "09")], "id int, ts string")
    previous = spark.createDataFrame([(1, "05")], "id int, ts string")
    fresh, following = incremental.new_rows(current, previous, "ts", "07")
    assert rows(fresh) == [(2, "06")]
    assert rows(following) == [(1, "05"), (2, "06")]


def test_catch_up_counts_a_row_in_its_first_pull(spark):
    df = spark.sql("SELECT explode(array(timestamp'2024-01-01 12:00:00', timestamp'2024-01-02', timestamp'2024-01-02 00:00:01', timestamp'2024-01-04')) AS ts")
    out = incremental.catch_up(df, "ts", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert rows(out.selectExpr("CAST(ts AS STRING) AS t", "pull")) == [("2024-01-01 12:00:00", 0), ("2024-01-02 00:00:00", 0), ("2024-01-02 00:00:01", 1)]


def test_snapshots_are_replaced_and_unfinished_ones_ignored(spark, tmp_path):
    store = incremental.SnapshotStore(spark, str(tmp_path / "s"))
    assert store.latest() is None
    store.save(spark.range(3), 1)
    store.save(spark.range(5), 2)
    store.save(spark.range(4), 2)
    assert store.latest().count() == 4 and store.latest(before=2).count() == 3
    (tmp_path / "s" / "batch=9").mkdir()
    assert store.latest().count() == 4


@pytest.mark.parametrize("seed", [0, 40, 10**6])
def test_ordered_neighbours_match_brute_force(spark, seed):
    rng = random.Random(seed)
    data = sorted({(rng.choice(["hot", "hot", "hot", "x", None]), rng.randint(0, 300)) for _ in range(200)}, key=str)
    data = [(k, t, rng.choice([None, None, t])) for k, t in data]
    df = spark.createDataFrame(data, "k string, t int, v int")
    out = ordered_neighbours(df, ["k"], ["t"], F.expr("t div 20"), {"nxt": "t"}, {"car": "v"}, {"top": "t"})
    want = []
    for k in {d[0] for d in data}:
        mine = sorted([(t, v) for kk, t, v in data if kk == k], key=lambda x: x[0])
        last = None
        for i, (t, v) in enumerate(mine):
            last = v if v is not None else last
            want.append((k, t, v, mine[i + 1][0] if i + 1 < len(mine) else None, last, mine[-1][0]))
    assert rows(out) == sorted(want, key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_rows_of_one_key_spread_over_tasks(spark):
    df = spark.range(2000).selectExpr("'k' AS k", "CAST(id AS INT) AS t", "CAST(id AS INT) AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ordered_neighbours(df, ["k"], ["t"], F.expr("t div 100"), {"nxt": "t"})
        assert out.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_equal_places_are_ordered_by_value(spark):
    df = spark.createDataFrame([("k", 1, v) for v in (5, 3, 4)] + [("k", 2, 9)], "k string, t int, v int")
    out = ordered_neighbours(df, ["k"], ["t"], F.lit(0), {"nxt": "v"})
    assert rows(out, "v", "nxt") == [(3, 4), (4, 5), (5, 9), (9, None)]


def test_gained_rows_add_up(spark, tmp_path):
    store = incremental.SnapshotStore(spark, str(tmp_path / "s"))
    assert store.known() is None
    for batch, n in ((1, 3), (2, 9), (2, 2)):  # the second batch runs twice
        store.save(spark.range(n), batch)
    assert store.known().count() == 5 and store.known(before=2).count() == 3


def by_month(spark, path, rows, mode="overwrite"):
    df = spark.createDataFrame(rows, "id int, at string, month string")
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return spark.read.schema("id int, at string, month string").parquet(path)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_pulls_read_only_months_that_differ(spark, tmp_path, monkeypatch):
    path, store = f"{tmp_path}/t", incremental.MonthStore(spark, f"{tmp_path}/s")
    rows = [(i, f"t{i}", f"20240{1 + i % 4}") for i in range(40)] + [(100, "t", None)]
    assert ids(store.pull(by_month(spark, path, rows), "month", 0)) == [*range(40), 100]
    asked = []
    real = incremental.of_months
    monkeypatch.setattr(incremental, "of_months", lambda df, month, months: asked.append(sorted(map(str, months))) or real(df, month, months))
    assert ids(store.pull(spark.read.schema("id int, at string, month string").parquet(path), "month", 1)) == []
    assert asked == [[], [], []]
    # one month is written again as it was, in other files; one gains two rows and loses one
    asked.clear()
    changed = [r for r in rows if r[2] == "202402" and r[0] != 1] + [(50, "t", "202402"), (51, "t", "202402")]
    by_month(spark, path, [r for r in rows if r[2] == "202403"])
    current = by_month(spark, path, changed)
    for _ in range(2):  # also when the batch is run again
        asked.clear()
        assert ids(store.pull(current, "month", 2)) == [50, 51]
        assert asked == [["202402", "202403"], ["202402"], ["202402"]]
    plan = real(current, "month", ["202402"])._jdf.queryExecution().executedPlan().toString()
    assert "202402" in plan.split("PartitionFilters")[1].split("]")[0]
    # the month without a name
    assert ids(store.pull(by_month(spark, path, [(100, "t", None), (101, "t", None)]), "month", 3)) == [101]
    # other columns: every month is compared
    asked.clear()
    store.pull(spark.read.schema("id int, month string").parquet(path), "month", 4, ignore=["at"])
    assert len(asked[0]) == 5


def test_ignored_columns_of_months(spark, tmp_path):
    path, store = f"{tmp_path}/t", incremental.MonthStore(spark, f"{tmp_path}/s")
    store.pull(by_month(spark, path, [(1, "a", "1"), (2, "a", "1"), (3, "a", "2")]), "month", 0, ignore=["at"])
    assert ids(store.pull(by_month(spark, path, [(1, "b", "1"), (2, "a", "1"), (4, "c", "1")]), "month", 1, ignore=["at"])) == [4]


def test_an_empty_table_by_month(spark, tmp_path):
    store = incremental.MonthStore(spark, f"{tmp_path}/s")
    empty = by_month(spark, f"{tmp_path}/t", [(1, "a", "1")]).limit(0)
    (tmp_path / "none").mkdir()
    nothing = spark.read.schema(empty.schema).parquet(f"{tmp_path}/none")
    assert store.pull(nothing, "month", 0).count() == 0 and store.pull(nothing, "month", 1).count() == 0


def test_strict_events_need_no_second_join(spark):
    """One window over an event's rows gives the rows of the two-step maximum, ties and missing sides included."""
    r = random.Random(5)
    made = [(r.choice(["a", "b", None]), r.choice([None, 1, 2, 3]), r.choice([None, 1, 2, 3]), r.randint(0, 2)) for _ in range(300)]
    df = spark.createDataFrame(made, "k string, l int, r int, x int")
    got = events.to_events(df, ["k"], "l", "r", "e", strict_compat=True)
    whole = df.withColumn("e", F.greatest("l", "r"))
    first = whole.groupBy("k", "e", "l").agg(F.max("r").alias("r"))
    want = first.groupBy("k", "e", "r").agg(F.max("l").alias("l")).join(whole, ["k", "e", "l", "r"])
    assert got.columns == want.columns and rows(got) == rows(want)
    assert "Join" not in got._jdf.queryExecution().analyzed().toString()
