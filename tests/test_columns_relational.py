import pytest
from pyspark.sql import functions as F

from flowframe.operators import columns, nesting, relational
from tests.helpers import rows


def people(spark):
    return spark.createDataFrame([("alice", 3), ("bob", 1), ("carol", 2)], "name string, val1 int")


def test_left_join_keeps_the_key_once_and_first(spark):
    left = spark.createDataFrame([("alice", 1), ("bob", 2), ("carol", 3)], "name string, val1 int")
    right = spark.createDataFrame([("alice", 5), ("bob", 6), ("carol", 4)], "name string, val2 int")
    out = relational.join(left, right, ["name"], "left")
    assert out.columns == ["name", "val1", "val2"]
    assert rows(out) == [("alice", 1, 5), ("bob", 2, 6), ("carol", 3, 4)]


def test_sort_then_filter(spark):
    out = columns.filter_rows(relational.sort(people(spark), "val1"), "val1 > 1")
    assert [r["name"] for r in out.collect()] == ["carol", "alice"]


@pytest.mark.parametrize("key", ["-val1", "val1 desc", "val1 DESC"])
def test_sort_descending_spellings(spark, key):
    assert [r["val1"] for r in relational.sort(people(spark), [key]).collect()] == [3, 2, 1]


def test_with_column(spark):
    out = columns.with_column(people(spark), "x", "concat_ws('-', name, val1)")
    assert rows(out, "x") == [("alice-3",), ("bob-1",), ("carol-2",)]


def test_with_columns_sees_earlier_and_overwritten_columns(spark):
    df = spark.createDataFrame([(2,)], "a int")
    out = columns.with_columns(df, [("b", "a + 1"), ("a", "a * 10"), ("c", "a + b"), ("a", "a + 1")])
    assert rows(out, "a", "b", "c") == [(21, 3, 23)]


def test_independent_columns_share_one_projection(spark):
    df = spark.range(3).toDF("a")
    out = columns.with_columns(df, [(f"c{i}", f"a + {i}") for i in range(30)])
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 2  # the rename and one projection


def test_explode_and_pop_twice(spark):
    df = spark.sql(
        "SELECT array(named_struct('table', array(named_struct('x', 1), named_struct('x', 2))), "
        "named_struct('table', array(named_struct('x', 3)))) AS data"
    )
    assert rows(columns.explode_pop(columns.explode_pop(df, "data"), "table")) == [(1,), (2,), (3,)]


def test_pop_struct_with_awkward_name(spark):
    df = spark.sql("SELECT 1 AS k, named_struct('x', 2) AS `a.b`")
    assert columns.pop_struct(df, "a.b").columns == ["x"]
    assert columns.pop_struct(df, "a.b", keep_rest=True).columns == ["k", "x"]


def test_split_puts_null_predicates_second(spark):
    df = spark.createDataFrame([(1,), (None,), (5,), (5,), (None,)], "v int")
    yes, no = relational.split(df, "v < 3")
    assert rows(yes) == [(1,)]
    assert rows(no) == [(None,), (None,), (5,), (5,)]
    assert rows(relational.split(df, "v < 3", distinct=True)[1]) == [(None,), (5,)]


def test_null_safe_anti_join_widens_and_ignores(spark):
    left = spark.createDataFrame([(1, None, "t1"), (2, "x", "t2"), (2, "x", "t3")], "id int, v string, ts string")
    right = spark.createDataFrame([(1, "other")], "id int, ts string")
    out = relational.anti_join_null_safe(left, right, ignore=["ts"])
    assert rows(out, "id", "v", "ts") == [(2, "x", "t2"), (2, "x", "t3")]


def test_union_with_a_missing_side(spark):
    df = people(spark)
    assert relational.union(df, None) is df
    assert relational.union(None, df) is df


def test_parts_hold_every_row_and_stay_small(spark):
    copies = spark.range(1000).select(F.lit("hot").alias("k"), F.lit(7).alias("v"))
    several = spark.range(500).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("v"))
    df = copies.unionByName(several).unionByName(spark.createDataFrame([("cold", 1), (None, 2)], "k string, v int"))
    out = nesting.push_struct_array(df, "vs", ["v"], max_items=100)
    sizes = [r["n"] for r in out.select(F.size("vs").alias("n")).collect()]
    assert sum(sizes) == 1502 and max(sizes) <= 250
    flat = out.select("k", F.inline("vs"))
    assert rows(flat.groupBy("k", "v").count()) == rows(df.groupBy("k", "v").count())


def test_nested_lists_need_a_group(spark):
    with pytest.raises(ValueError):
        nesting.push_struct_array(people(spark), "x", ["name", "val1"])


def test_json_paths_with_quotes_sort(spark):
    df = spark.createDataFrame([('{"id": 2}',), ('{"id": 1}',), ('{"id": "x"}',)], "m string")
    assert [r["sort_key"] for r in relational.sort_by_json_field(df, "m", "$['id']").collect()] == [1, 2]


def test_hot_keys_are_split_over_partitions(spark):
    df = spark.range(10000).select(F.lit("hot").alias("k"), F.col("id").alias("s"))
    out = relational.partition_sort(df, ["k"], ["s"], n=4).select(F.spark_partition_id().alias("p"), "s")
    parts = {r["p"]: (r["lo"], r["hi"]) for r in out.groupBy("p").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).collect()}
    assert len(parts) > 1
    ranges = [parts[p] for p in sorted(parts)]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    from flowframe.sources.files import read_files

    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id * 2 AS b", "id * 3 AS c").write.parquet(path)
    df = read_files(spark, path, "parquet", project=[("id", "key"), ("b", "val")], where="key > 5").select("val")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint,b:bigint>" in plan
