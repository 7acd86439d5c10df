import json
import os

import pytest

from flowframe.operators import incremental, rules
from flowframe.plans import flow
from flowframe.sources import external, files, landing, sinks
from flowframe.streaming import batches
from flowframe.streaming import files as stream_files
from tests.helpers import rows


def op(kind, sources, sinks_, **options):
    return {"operatorType": kind, "signals": {"sources": [{"signalId": s} for s in sources], "sinks": [{"signalId": s} for s in sinks_]}, "options": options}


def test_unknown_missing_and_cyclic_flows_are_told(spark):
    with pytest.raises(flow.FlowError, match="unknown operator"):
        flow.build_flow(spark, {"operations": [op("nope", [], ["x"])]}, "x")
    with pytest.raises(flow.FlowError, match="no operation produces"):
        flow.build_flow(spark, {"operations": [op("filter", ["gone"], ["x"])]}, "x")
    with pytest.raises(flow.FlowError, match="cycle"):
        flow.build_flow(spark, {"operations": [op("filter", ["b"], ["a"]), op("filter", ["a"], ["b"])]}, "a")
    with pytest.raises(flow.FlowError, match="unknown connection"):
        flow.build_flow(spark, {"operations": [op("reader", [], ["a"])]}, "a")


def test_a_signal_is_built_once(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spec = {"connections": [{"id": "c", "connectionType": "local", "options": {"path": str(tmp_path), "filesFormat": "PARQUET"}}],
            "operations": [{"operatorType": "reader", "signals": {"sources": [{"connectionId": "c"}], "sinks": [{"signalId": "in"}]}, "options": {"path": "t"}},
                           op("tee", ["in"], ["a", "b"]), op("union", ["a", "b"], ["u"])]}
    built = flow.parse_flow(spark, spec)
    assert built.frame("a") is built.frame("b")
    assert built.frame("u").count() == 6


def test_operator_option_beats_connection_option(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\n1;2\n")
    spec = {"connections": [{"id": "c", "connectionType": "local", "options": {"path": str(tmp_path), "filesFormat": "CSV", "filesFormatCsvSeperator": ",", "header": "false"}}],
            "operations": [{"operatorType": "reader", "signals": {"sources": [{"connectionId": "c"}], "sinks": [{"signalId": "in"}]}, "options": {"filesFormatCsvSeperator": ";", "header": "true"}}]}
    assert rows(flow.build_flow(spark, spec, "in"), "a", "b") == [(1, 2)]


def test_project_in_the_older_dialect_renames(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    spec = {"connections": [{"id": "c", "connectionType": "local", "options": {"path": str(tmp_path / "t"), "filesFormat": "PARQUET"}}],
            "flows": [{"name": "p", "type": "project", "cols": [{"from": "id", "name": "key"}], "source": {"type": "reader", "connection": "c"}}]}
    assert flow.build_flow(spark, spec, "p").columns == ["key"]


def test_preview_splits_errors_and_writes_nothing(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "t"))

    def refuse(context, row):
        if row["id"] == 7:
            raise ValueError("seven")
        return row

    spec = {"connections": [{"id": "c", "connectionType": "local", "options": {"path": str(tmp_path / "t"), "filesFormat": "PARQUET"}}],
            "operations": [{"operatorType": "reader", "signals": {"sources": [{"connectionId": "c"}], "sinks": [{"signalId": "in"}]}},
                           op("ruleScript", ["in"], ["out"], methodNames=["refuse"], schema="id bigint")]}
    seen = flow.preview(spark, spec, "out", n=5, count=True, functions={"refuse": refuse})
    assert len(seen.rows) == 5 and seen.count == 49 and seen.errors[0]["_error"] == "refuse: ValueError: seven"
    with pytest.raises(flow.FlowError):
        flow.build_flow(spark, spec, "out")


def test_uris():
    assert files.resolve_path("/a/", "/b/c") == "/a/b/c" and files.resolve_path(None, "x") == "x"
    assert files.connection_uri("blob-storage", "/p/q", "cont", "acct.dfs.example.net") == "abfs://cont@acct.dfs.example.net/p/q"
    assert files.connection_uri("hdfs", "/p") == "hdfs:///p"
    with pytest.raises(ValueError):
        files.resolve_path(None, "")


def test_bus_and_database_options_of_flows(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(external, "read_event_bus", lambda spark, servers, topics, **kw: seen.update(kw, topics=topics) or spark.range(1))
    monkeypatch.setattr(external, "read_jdbc", lambda spark, url, **kw: seen.update(kw) or spark.range(1))
    bus = {"id": "b", "connectionType": "event-hub-read", "connection": {"connectionStrings": {"servers": "h:1"}}, "options": {"topics": "t", "schema": "a int", "maxRatePerPartition": "9"}}
    base = {"id": "d", "connectionType": "jdbc", "connection": {"connectionStrings": {"url": "jdbc:x"}}, "options": {"table": "t", "partition": ["id", "0", "100", "4"]}}
    for c in (bus, base):
        read = {"operatorType": "reader", "signals": {"sources": [{"connectionId": c["id"]}], "sinks": [{"signalId": "in"}]}}
        flow.build_flow(spark, {"connections": [c], "operations": [read]}, "in")
    assert (seen["start"], seen["rate"], seen["topics"], seen["partition"]) == ("earliest", 9, "t", ("id", 0, 100, 4))
    del bus["options"]["schema"]
    with pytest.raises(flow.FlowError, match="schema"):
        read = {"operatorType": "reader", "signals": {"sources": [{"connectionId": "b"}], "sinks": [{"signalId": "in"}]}}
        flow.build_flow(spark, {"connections": [bus], "operations": [read]}, "in")


def test_reader_options_of_external_systems(spark):
    assert external.bus_options("h:1", "t", "smallest", 500)["startingOffsets"] == "earliest"
    assert external.bus_options("h:1", "t", "smallest", 500)["maxOffsetsPerTrigger"] == "500"
    with pytest.raises(ValueError):
        external.read_jdbc(spark, "jdbc:x")


def test_save_modes():
    assert [sinks.save_mode(m) for m in (None, "overwrite", "ignore", "errExists", "append", "other")] == ["overwrite", "overwrite", "ignore", "errorifexists", "append", "append"]


def test_jdbc_frame_handles_decimals_and_nested_columns(spark):
    df = spark.sql("SELECT CAST(1.50 AS DECIMAL(10,2)) AS d, array(1, 2) AS xs, CAST(NULL AS STRING) AS k1, 'b' AS k2")
    assert rows(sinks.jdbc_frame(df.union(df), ["k1", "k2"]), "df_key", "xs") == [("b", "[1,2]")]


def land(spark, root, **more):
    return landing.land_csv(spark, str(root), ["id"], ["day", "time"], "yyyy-MM-dd HH:mm", "UTC", **more)


def drop(root, **contents):
    for name, text in contents.items():
        folder = root / "2021" / "01" / name
        folder.mkdir(parents=True)
        (folder / f"{name}.csv").write_text(text)


GOOD = "id,day,time,v\n1,2021-01-02,10:00,a\n2,2021-01-02,11:00,b\n"


def verdicts(landed):
    return {os.path.basename(r["path"]).split(".")[0]: r["error_type"] for r in landed.verdicts.collect()}


def test_landing_verdicts_and_rows(spark, tmp_path):
    drop(
        tmp_path,
        good=GOOD,
        later="v,time,day,id\na,10:00,2021-01-05,1\n",  # another order, an exact duplicate later
        extra='id,day,time,v,more col\n3,2021-01-02,10:00,"a,b",x\n',
        nokey="key,day,time,v\n9,2021-01-02,10:00,a\n",
        dup="id,day,time,v,v\n9,2021-01-02,10:00,a,b\n",
        badts="id,day,time,v\n9,2021-01-02,10:00,a\n8,someday,10:00,a\n",
        ragged="id,day,time,v\n9,2021-01-02,10:00\n",
        nullkey="id,day,time,v\n,2021-01-02,10:00,a\n",
        empty="",
    )
    out = land(spark, tmp_path)
    assert verdicts(out) == {
        "good": None, "later": None, "extra": None, "nullkey": None, "nokey": "missing_key_columns",
        "dup": "duplicate_columns", "badts": "unparsable_timestamp", "ragged": "malformed_rows",
    }
    assert rows(out.rows, "id", "v", "more_col", "DERIVED_TS", "FILENAME_TS") == [
        ("1", "a", None, "2021-01-02T10:00:00.000Z", "good.csv"),
        ("2", "b", None, "2021-01-02T11:00:00.000Z", "good.csv"),
        ("3", "a,b", "x", "2021-01-02T10:00:00.000Z", "extra.csv"),
    ]
    assert out.quarantine.count() == 5 and out.quarantine.filter("__error__ IS NULL").count() == 0


def test_landing_first_file_only_and_config_errors(spark, tmp_path):
    drop(tmp_path, a=GOOD, b=GOOD.replace("1,", "7,"))
    assert rows(land(spark, tmp_path, first_file_only=True).rows, "id") == [("1",), ("2",)]
    for bad in (dict(keys=[]), dict(src_ts=[]), dict(pattern=" "), dict(zone="Nowhere/City")):
        args = {"keys": ["id"], "src_ts": ["day"], "pattern": "yyyy-MM-dd", "zone": "UTC", **bad}
        with pytest.raises(ValueError):
            landing.land_csv(spark, str(tmp_path), **args)


def test_headers_by_opening_files_or_by_scanning(spark, tmp_path):
    drop(tmp_path, a=GOOD, b='"x,y",v\r\n1,2\r\n', c="id,day,time,v\n", d="")
    found = [landing.header_groups(spark, str(tmp_path), open_files=o) for o in (False, True)]
    plain = [[(g.names, sorted(os.path.basename(p) for p in g.paths)) for g in groups] for groups in found]
    assert plain[0] == plain[1] == [(["x,y", "v"], ["b.csv"]), (["id", "day", "time", "v"], ["a.csv", "c.csv"])]
    assert rows(land(spark, tmp_path / "2021/01/a", open_files=True).rows, "id") == [("1",), ("2",)]


def test_failed_files_are_moved_aside(spark, tmp_path):
    root = tmp_path / "in"
    drop(root, a=GOOD, nokey="key,day,time\n9,2021-01-02,10:00\n")
    assert landing.embargo_files(spark, land(spark, root).verdicts, str(root)) == 1
    assert (tmp_path / "in_embargo/2021/01/nokey/nokey.csv").exists() and not (root / "2021/01/nokey/nokey.csv").exists()


def test_all_files_failing(spark, tmp_path):
    drop(tmp_path, nokey="key,day,time\n9,2021-01-02,10:00\n")
    out = land(spark, tmp_path)
    assert out.rows.count() == 0 and verdicts(out) == {"nokey": "missing_key_columns"}


def test_rules_run_in_order_and_keep_failing_rows(spark):
    def double(context, row):
        row["v"] *= context["by"]
        return row

    def check(context, row):
        if row["v"] > 5:
            raise RuntimeError("too large")
        row["note"] = "ok"

    out = rules.apply_rules(spark.createDataFrame([(1,), (3,)], "v int"), [double, check], "v int, note string", {"by": 2})
    assert rows(out) == [(2, None, None), (6, None, "check: RuntimeError: too large")]


def test_a_result_of_the_wrong_type_is_an_error_row(spark):
    def wrong(context, row):
        row["n"] = "seven" if row["v"] == 2 else row["v"]
        return row

    out = rules.apply_rules(spark.createDataFrame([(1,), (2,), (3,)], "v int"), [wrong], "v int, n int")
    assert [(r["v"], r["n"], (r["_error"] or "")[:2]) for r in out.orderBy("v").collect()] == [(1, 1, ""), (2, None, "n:"), (3, 3, "")]


def test_only_blank_headers_are_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,_code,,at\n1,x,gone,2020-01-01 00:00:00\n")
    out = landing.land_csv(spark, str(tmp_path), ["id"], ["at"], "yyyy-MM-dd HH:mm:ss", "UTC").rows
    assert "_code" in out.columns and rows(out, "id", "_code") == [("1", "x")] and not any("gone" in map(str, r) for r in out.collect())


@pytest.mark.parametrize("start,till,want", [("", "", 3), ("202002", "", 2), ("", "202002", 2), ("202002", "202002", 1)])
def test_month_ends_are_open(spark, tmp_path, start, till, want):
    df = spark.createDataFrame([(1, "202001"), (2, "202002"), (3, "202003")], "a int, yearmonth string")
    df.write.partitionBy("yearmonth").parquet(str(tmp_path / "m"))
    got = files.read_month_partitions(spark, str(tmp_path / "m"), {"a": "a"}, None, start=start, till=till)
    assert got.count() == want


def test_compaction_follows_the_size(spark, tmp_path):
    spark.range(20_000).repartition(12).write.parquet(str(tmp_path / "in"))
    sinks.compact_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    sinks.compact_files(spark, str(tmp_path / "in"), str(tmp_path / "more"), file_bytes=40_000)
    assert len(list((tmp_path / "more").glob("part-*"))) > 2 and spark.read.parquet(str(tmp_path / "more")).count() == 20_000


def test_event_bodies_get_a_common_schema(spark):
    df = spark.createDataFrame([(json.dumps({"a": 1, "b": "x"}),), (json.dumps({"a": 2, "c": {"d": 1.5}}),), ("{bad",)], "body string")
    out = external.parse_bodies(df).filter("a IS NOT NULL")
    assert rows(out.selectExpr("CAST(a AS INT)", "b", "CAST(c.d AS DOUBLE)")) == [(1, "x", None), (2, None, 1.5)]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    batches.write_batch(spark.range(3), out, 0)
    batches.write_batch(spark.range(3), out, 0)
    batches.write_batch(spark.range(2), out, 1)
    assert spark.read.parquet(out).count() == 5


def test_archived_files_keep_their_paths(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    archive.mkdir()
    spark.range(4).write.json(str(source))
    for run in range(3):  # files are archived once a later batch has been planned
        stream = stream_files.file_stream(spark, str(source), "json", "id BIGINT", archive=str(archive))
        batches.run_batches(stream, lambda df, i: batches.write_batch(df, str(tmp_path / "out"), i), str(tmp_path / "cp")).awaitTermination()
        spark.range(10 + run, 11 + run).write.mode("append").json(str(source))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    assert any(f.endswith(".json") for _, _, names in os.walk(archive) for f in names)


def test_offset_gap_is_reported_once(spark):
    data = [("t", 0, 1, 0, 10), ("t", 0, 2, 10, 20), ("t", 0, 3, 25, 30), ("t", 1, 3, 5, 9)]
    df = spark.createDataFrame(data, "topic string, partition int, batch_id long, from_offset long, until_offset long")
    assert rows(batches.offset_gaps(df, block=2)) == [("t", 0, 3, 25, 20)]


def test_schema_evolution(spark, tmp_path):
    sinks.write_with_schema(spark.sql("SELECT 1 AS a, 'x' AS b, 2.0D AS c"), str(tmp_path / "new"))
    sinks.write_files(spark.sql("SELECT 5 AS a"), str(tmp_path / "old"))
    out = sinks.schema_evolution_read(spark, str(tmp_path / "old"), str(tmp_path / "new.schema"))
    assert rows(out) == [(5, "", None)] and dict(out.dtypes)["c"] == "double"


def test_unreadable_avro_is_spark_s_error_not_ours(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        files.read_files(spark, str(tmp_path), "AVRO").collect()


def test_mapping_preview(spark):
    row = {"name": "t", "colFamily": "f", "rowKey": ["$.id"], "cols": [{"name": "id", "value": "$.id"}]}
    spec = {"version": "0.4", "templates": [{"name": "t", "row": row}], "sourceMap": [{"sourceName": "s", "templates": ["t"], "when": "topic == 'x'"}]}
    seen = flow.preview_mapping(spark, spec, "x", ['{"id": "7"}', "{bad"])
    assert [r["row_key"] for r in seen.rows] == ["7"] and seen.errors == [{"topic": "x", "value": "{bad"}]


def test_sorting_a_hot_key_uses_several_tasks(spark):
    from pyspark.sql import functions as F

    from flowframe.operators.relational import sort

    df = spark.range(0, 20000, 1, 8).select(F.lit("hot").alias("k"), F.col("id"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = sort(df, "k").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_a_pull_that_runs_again_changes_nothing(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3).write.parquet(source)
    store = incremental.SnapshotStore(spark, str(tmp_path / "state"))
    spec = {"connections": [{"id": n, "connectionType": "local", "options": {"path": p, "filesFormat": "PARQUET"}} for n, p in (("in", source), ("out", target))],
            "operations": [{"operatorType": "reader", "signals": {"sources": [{"connectionId": "in"}], "sinks": [{"signalId": "a"}]}},
                           {"operatorType": "writer", "id": "w", "signals": {"sources": [{"signalId": "a"}], "sinks": [{"connectionId": "out"}]}, "options": {"prefetch": {"save": "true"}}}]}
    flow.pull_flow(spark, spec, "w", store, 0)
    spark.range(3, 5).write.mode("append").parquet(source)
    for _ in range(2):
        assert rows(flow.pull_flow(spark, spec, "w", store, 1)) == [(3,), (4,)]
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(flow.FlowError):
        flow.pull_flow(spark, spec, "nobody", store, 2)


def test_a_day_counts_to_its_end(spark):
    landed = spark.createDataFrame([(1, "2021-03-05T10:00:00.000Z"), (2, "2021-03-06T00:00:00.000Z"), (3, "2021-03-04T00:00:00.000Z")], "id int, DERIVED_TS string")
    none = landed.limit(0)
    assert rows(landing.land_newest(landed, none, "2021-03-05")[0], "id") == [(1,), (3,)]
    assert rows(landing.land_newest(landed, none, "2021-03-05", whole_days=False)[0], "id") == [(3,)]


def test_placeholders_and_json_connections(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 5}\n')
    spec = {"connections": [{"id": "c", "connectionType": "local", "options": {"path": "<ROOT>/<NAME>.json"}}],
            "operations": [{"operatorType": "simpleJsonFile", "signals": {"sources": [{"connectionId": "c"}], "sinks": [{"signalId": "s"}]}, "options": {"note": "<KEEP>"}}]}
    filled = flow.fill_spec(spec, {"ROOT": str(tmp_path), "NAME": "a"})
    assert filled["operations"][0]["options"]["note"] == "<KEEP>"
    assert rows(flow.build_flow(spark, filled, "s")) == [(5,)]


def test_spans_of_whole_loads():
    from datetime import date

    assert landing.recent_months(date(2024, 2, 10)) == ("202302", "20240229")
    assert landing.recent_months(date(2023, 12, 31), 1) == ("202311", "20231231")
    assert landing.day_after("20211231") == "2022-01-01"


def test_landing_of_months_without_data(spark, tmp_path):
    with pytest.raises(ValueError, match="no data"):
        landing.land_initial(spark, str(tmp_path), "202101", "202103", ["id"], ["at"], "dd.MM.yyyy")
