import json

import pytest
from pyspark.sql import functions as F

from flowframe.functions import jsonpath as jp
from flowframe.functions import mapexpr as me
from flowframe.operators import mapping
from tests.helpers import rows

MESSAGES = [
    {"header": {"source": "dhldgf", "category": "shipmentDetails", "version": "1.0", "timestamp": "1567274587915"}, "data": {"lspTrackingId": "11111", "vendor": "dhldgf", "weight": ""}},
    {"header": {"source": "upsAir", "category": "shipmentDetails", "version": "1.0", "timestamp": "1566547505036"}, "data": {"lspTrackingId": "00000", "vendor": "upsAir"}},
]


def frame(spark, docs=MESSAGES, topic="shipmentDetails"):
    return spark.createDataFrame([(topic, d if isinstance(d, str) else json.dumps(d)) for d in docs], "topic string, value string")


def col(name, value, dedup=False, **more):
    return {"name": name, "value": value, "isDedup": dedup, **more}


def spec(cols, key, when="( ( topic == 'shipmentDetails' ) && ( $.header.source == 'dhldgf' ) )", family="fp", **more):
    row = {"colFamily": family, "name": "details_event", "namespace": "test", "rowKey": key, "cols": cols}
    keys = {"idockey": ["$.header.timestamp"], "sortkey": ["$.header.timestamp", "$.header.category"]}
    return {
        "version": "0.4.1",
        "templates": [{"name": "t", "row": row, **more}],
        "sourceMap": [{"sourceName": "s", "templates": ["t"], "when": when, **keys}],
    }


THREE = [col("source", "$.header.source", True), col("vendor", "$.data.vendor", True), col("ref", "$.data.lspTrackingId", True)]


def test_when_selects_and_builds_keys(spark):
    out = mapping.map_documents(frame(spark), spec(THREE, ["ref", "source"]))
    (row,) = out.rows.collect()
    assert row["row_key"] == "11111-dhldgf" and row["sort_key"] == "1567274587915-shipmentDetails"
    assert row["cells"] == {"source": "dhldgf", "vendor": "dhldgf", "ref": "11111"}
    # a leading zero of the hash is lost
    assert row["dedup_key"] == "33b30d4f0eadd7938907ed9f61b3b2e"
    # ids of all messages, matching or not
    assert rows(out.doc_ids) == [("shipmentDetails", "1566547505036"), ("shipmentDetails", "1567274587915")]


def test_literal_in_row_key_and_several_matches(spark):
    both = spec(THREE, ["ref", "source"])
    both["templates"].append({**both["templates"][0], "name": "two", "row": {**both["templates"][0]["row"], "rowKey": ["ref", "source", "'two'"]}})
    both["sourceMap"].append({**both["sourceMap"][0], "templates": ["two"]})
    assert rows(mapping.map_documents(frame(spark), both).rows, "row_key") == [("11111-dhldgf",), ("11111-dhldgf-two",)]


def test_no_match_gives_no_rows(spark):
    out = mapping.map_documents(frame(spark), spec(THREE, ["ref"], when="topic == 'other'"))
    assert out.rows.count() == 0


def test_families_on_column_beat_the_row(spark):
    cols = [col("a", "$.header.source", colFamily="fp2"), col("b", "$.data.vendor"), col("fp3:c", "$.data.vendor"), col("d", "$.data.weight", colFamily="fp4")]
    out = mapping.map_documents(frame(spark), spec(cols, ["$.data.lspTrackingId"])).rows
    got = {r["family"]: r["cells"] for r in out.collect()}
    assert got == {"fp": {"b": "dhldgf"}, "fp2": {"a": "dhldgf"}, "fp3": {"c": "dhldgf"}}
    assert {r["row_key"] for r in out.collect()} == {"11111"}


def test_missing_key_parts_and_unbound_names(spark):
    cols = [col("w", "$.data.weight")]
    out = mapping.map_documents(frame(spark), spec(cols + THREE, ["w", "$.data.none", "word", "ref"])).rows
    assert out.first()["row_key"] == "?-?-word-11111"


def test_sql_values_read_missing_paths_as_empty_text(spark):
    cols = [col("x", "concat($.data.none, '[', $.data.vendor, ']')"), col("y", "CASE WHEN $.data.weight = '' THEN '$.data.vendor' ELSE 'no' END")]
    cells = mapping.map_documents(frame(spark), spec(cols, ["'k'"])).rows.first()["cells"]
    assert cells == {"x": "[dhldgf]", "y": "$.data.vendor"}


def test_children_single_object_list_and_grandparent(spark):
    doc = {"id": "d", "one": {"n": 1}, "list": [{"n": 2, "deep": [{"m": 3}, {"m": 4}]}, {"n": 5}]}
    template = lambda name, cols, key, kids=(): {"name": name, "row": {"name": name, "colFamily": "f", "rowKey": key, "cols": cols}, "children": list(kids)}
    mapped = {
        "version": "0.4",
        "templates": [
            template("root", [col("id", "$.id")], ["id"], [{"template": "kid", "select": "$.one"}, {"template": "kid", "select": "$.list"}, {"template": "leaf0", "select": "$.list[*].deep"}]),
            template("kid", [col("n", "$.n")], ["../$.id", "n"], [{"template": "leaf", "select": "$.deep"}]),
            template("leaf", [col("m", "$.m")], ["../../$.id", "../$.n", "m"]),
            template("leaf0", [col("m", "$.m")], ["'direct'", "../$.id", "m"]),
        ],
        "sourceMap": [{"sourceName": "s", "templates": ["root"], "when": "true"}],
    }
    out = mapping.map_documents(frame(spark, [doc]), mapped).rows
    assert rows(out, "table_name", "row_key") == [
        ("kid", "d-1"), ("kid", "d-2"), ("kid", "d-5"), ("leaf", "d-2-3"), ("leaf", "d-2-4"), ("leaf0", "direct-d-3"), ("leaf0", "direct-d-4"), ("root", "d"),
    ]


def test_bad_records_are_rejected_and_the_rest_goes_on(spark):
    text = json.dumps(MESSAGES[0]) + "\n\n" + "{bad" + "\r\n" + json.dumps(MESSAGES[0])
    out = mapping.map_documents(frame(spark, [text]), spec(THREE, ["ref"]))
    assert out.rows.count() == 2 and rows(out.rejects, "value") == [("{bad",)]


def test_versions_compare_as_numbers():
    assert mapping.version_of({"version": "0.10.1"}) > mapping.version_of({"version": "0.4"})


def test_path_above_the_document_is_refused(spark):
    with pytest.raises(ValueError):
        mapping.map_documents(frame(spark), spec([col("x", "../$.id")], ["x"]))


DOC = {
    "myObj": {
        "myTrue": True, "myInt": 42, "myFloat": 123.44, "myFoo": "foo", "myArray": ["x", "y", "z"],
        "objArray": [{"k1": True, "k2": "o1"}, {"k1": False, "k2": "o2"}, {"k1": True, "k2": "o3"}, {"k1": False, "k2": "o4"}, {"k1": True, "k2": "o5"}],
    }
}


def one(spark, column):
    df = spark.createDataFrame([(json.dumps(DOC),)], "v string").select(F.parse_json("v").alias("doc"))
    return df.select(column.alias("x")).first()["x"]


def test_paths(spark):
    obj = jp.path(F.col("doc")).field("myObj")
    arr, objs = obj.field("myArray"), obj.field("objArray")
    assert one(spark, obj.field("myFoo").first()) == "foo"
    assert one(spark, obj.field("myTrue").first()) == "true"
    assert one(spark, obj.field("myInt").first()) == "42"
    assert one(spark, obj.field("myFloat").first()) == "123.44"
    assert one(spark, arr.index(1).first()) == "y"
    assert one(spark, arr.each().joined()) == "xyz"
    assert one(spark, arr.first()) == '["x","y","z"]'
    assert one(spark, objs.where(lambda x: jp.same_bool(x, "k1", True)).field("k2").joined()) == "o1o3o5"
    assert one(spark, objs.index(4).field("k2").first()) == "o5"
    assert one(spark, obj.field("none").first()) is None


def test_slices(spark):
    arr = jp.path(F.col("doc")).field("myObj").field("myArray")
    assert one(spark, arr.slice(0, 2).joined()) == "xy"
    assert one(spark, arr.slice(-2).joined()) == "yz"
    assert one(spark, arr.slice(step=2).joined()) == "xz"
    assert one(spark, arr.slice(step=-1).joined()) == "zyx"
    assert one(spark, arr.slice(1, 1).joined()) == ""


def test_recursive_paths_and_their_depth(spark):
    doc = jp.path(F.col("doc"))
    assert one(spark, doc.deep_field("k2").joined()) == "o1o2o3o4o5"
    assert one(spark, doc.deep_where(lambda x: jp.same_text(x, "k2", "o4")).count()) == 1


def test_descent_reaches_the_bottom(spark):
    text = '{"a": "]}\\\\\\""}'
    for i in range(40):
        text = f'{{"k": [{text}]}}' if i % 3 else f'{{"k": {text}, "flat": [1, {{"b": 2}}]}}'
    df = spark.createDataFrame([(text,), ("[]",), (None,)], "t string").select(F.try_parse_json("t").alias("doc"))
    got = [r[0] for r in df.select(jp.path(F.col("doc")).deep_field("a").count()).collect()]
    assert got == [1, 0, 0] or got == [1, 0, None]


def test_expressions(spark):
    two, three = F.lit(2), F.lit(3)
    assert one(spark, me.plus(two, two)) == 4
    assert one(spark, me.minus(me.times(two, three), three)) == 3
    assert one(spark, me.join("-", me.plus(two, two), me.times(two, three), me.plus(two, two))) == "4-6-4"
    assert one(spark, me.plus(F.lit("2.5"), F.lit(1))) == 1
    assert one(spark, me.divide(F.lit(-7), two)) == -3
    assert one(spark, me.divide(two, F.lit(0))) is None
    assert one(spark, me.round_half_up(F.lit(-2.5))) == -2 and one(spark, me.round_half_up(F.lit(2.5))) == 3
    assert one(spark, me.substring(F.lit("abcdef"), 1, 3)) == "bc"
    assert one(spark, me.substring(F.lit("abcdef"), 2, 0)) == "cdef"
    assert one(spark, me.substring(F.lit("abc"), 1, 9)) is None
    assert one(spark, me.matches(F.lit("abc"), "b")) is False and one(spark, me.matches(F.lit("abc"), "a|abc")) is True
    assert one(spark, me.compare(F.lit(10), "<", F.lit(9))) is True
    assert one(spark, me.truthy(F.lit("false"))) is True and one(spark, me.truthy(F.lit(None).cast("string"))) is False
    assert one(spark, me.trim(F.lit("\t a \n"))) == "a"


def test_top_item_inside_a_document(spark):
    data = [("10", "000000"), ("20", "10"), ("30", "20"), ("40", "99"), ("50", "60"), ("60", "50")]
    items = F.array(*[F.struct(F.lit(i).alias("item"), F.lit(p).alias("parent")) for i, p in data])
    got = [one(spark, me.top_item(items, "item", "parent", F.lit(x))) for x in ("10", "30", "40", "50", "77")]
    assert got == ["10", "10", "n/a", "cycle", "n/a"]


def mapped_cells(spark, doc, values, children=None, when="true", **more):
    cols = [{"name": f"c{i}", "value": v} for i, v in enumerate(values)]
    spec = {
        "sourceMap": [{"sourceName": "s", "when": when, "templates": ["t"], "idockey": ["$.id"]}],
        "templates": [
            {"name": "t", "row": {"name": "T", "rowKey": ["$.id"], "colFamily": "f", "cols": cols}, "children": children or []},
            {"name": "kid", "row": {"name": "K", "rowKey": ["../$.id", "$.n"], "colFamily": "f", "cols": [{"name": "v", "value": "$.v[*]"}]}},
        ],
        **more,
    }
    frame = spark.createDataFrame([("t", json.dumps(doc) if not isinstance(doc, str) else doc)], "topic string, value string")
    return mapping.map_documents(frame, spec)


ORDER = {
    "id": "o1",
    "num": "seven",
    "lines": [{"n": 1, "kind": "a", "q": 5, "v": ["x", "y"]}, {"n": 2, "kind": "b", "q": 9, "v": ["z"]}, {"n": 3, "kind": "a", "q": 7, "v": []}],
    "deep": {"flag": "F1", "in": {"flag": "F2", "list": [{"flag": "F3"}]}},
}


def test_specs_take_every_path_form(spark):
    values = [
        "$.lines[*].n", "$.lines[-1].n", "$.lines[0,2].kind", "$.lines[1:].n", "$.lines[?(@.kind == 'a' && @.q > 5)].n", "$..flag",
        "$.deep.*", "$.lines[?(@.q >= 9)].kind", "concat('<', $.lines[*].n, '>')", "concat($..flag, '')", "$.lines[?(@.gone)].n", "$.lines[::-1].n", "$['id','num']",
    ]
    got = mapped_cells(spark, ORDER, values).rows.first()["cells"]
    assert got == {"c0": "1", "c1": "3", "c2": "a", "c3": "2", "c4": "3", "c5": "F1", "c6": "F1", "c7": "b", "c8": "<123>", "c9": "F1F2F3", "c11": "3", "c12": "o1"}


def test_children_are_chosen_by_filters(spark):
    kids = [{"template": "kid", "select": "$.lines[?(@.kind == 'a')]"}, {"template": "kid", "select": "$..list"}]
    got = mapped_cells(spark, ORDER, ["$.id"], kids).rows.where("table_name = 'K'").collect()
    assert [(r["row_key"], r["cells"]["v"]) for r in got] == [("o1-1", "x")]


def test_bad_values_do_not_stop_the_job(spark):
    got = mapped_cells(spark, ORDER, ["CAST($.num AS INT)", "'CAST(x'", "$.id"], when="NOT coalesce($.num == 7, false)", badValues="null").rows.first()
    assert got["cells"] == {"c1": "CAST(x", "c2": "o1"}
    assert mapped_cells(spark, ORDER, ["$.id"], when="$.num == 7").rows.count() == 0
    assert mapped_cells(spark, {**ORDER, "num": "7"}, ["$.id"], when="$.num == 7").rows.count() == 1


def test_topics_by_any_path(spark):
    df = spark.createDataFrame([(json.dumps(ORDER),), ("{}",), ("x",)], "value string")
    assert [r["topic"] for r in mapping.extract_topic(df, "$.lines[?(@.n == 2)].kind").collect()] == ["b", "unknown", None]


def only_cells(spark, doc, values, **more):
    return mapped_cells(spark, doc, values, **more).rows.where("table_name = 'T'").first()["cells"]


def test_helpers_of_specs(spark):
    doc = {"a": " Ab\tc ", "n": "-2.5", "m": "7", "empty": "", "it's": "q", "l": ["x", "y"], "lines": [{"n": 1}]}
    values = {
        "toUpper($.a)": " AB\tC ", "toLower($.a)": " ab\tc ", "trim($.a)": "Ab\tc", "concat($.m, $.gone)": "7", "concat(toUpper(trim($.a)), '-', $.l[*])": "AB\tC-xy",
        "join(',', $.m, $.gone, 'x,y)')": "7,,x,y)", "matches($.m, '\\\\d')": "true", "matches($.a, 'Ab')": "false", "subString('abcdef', 1, 3)": "bc",
        "subString($.m, 0, -1)": "7", "round($.n)": "-2", "round('2.5')": "3", "round(2.345, 2)": "2.35", "not($.empty)": "true", "not($.m)": "false",
        "not($.m == '7')": "false", "if $.m == '7' then 'seven' else 'other'": "seven", "if $.empty then 1 else if $.m && $.n < 0 then 2 else 3": "2",
        "if (not($.m) || $.m > 6) then concat('<', if $.gone then 'a' else 'b', '>') else 'no'": "<b>",
        "CASE WHEN $.m = 7 THEN 'then' ELSE 'if' END": "then", "IF($.m = 7, 'y', 'n')": "y", "$.m + 1": "8", "abs($.m) || 'x'": "7.0x", "now() > 1700000000000": "true",
    }
    got = only_cells(spark, doc, list(values))
    assert {e: got.get(f"c{i}") for i, e in enumerate(values)} == values


def test_the_top_item_of_a_message(spark):
    items = [{"POSEX": "000010", "UEPOS": "000000"}, {"POSEX": "000020", "UEPOS": "000010"}, {"POSEX": "000030", "UEPOS": "000020"}, {"POSEX": "5", "UEPOS": "6"}, {"POSEX": "6", "UEPOS": "5"}, {"POSEX": "000040"}]
    values = ["topHli('000030')", "topHli($.which)", "topHli($.gone)", "topHli('5')", "topHli('000040')", "topHli('99')"]
    got = only_cells(spark, {"which": "000020", "ZORDER": {"IDOC": {"E1EDP01": items}}}, values)
    assert [got[f"c{i}"] for i in range(6)] == ["000010", "000010", "000010", "cycle", "000040", "99"]
    single = only_cells(spark, {"Z": {"IDOC": {"E1EDP01": items[0]}}}, ["topHli('000010')"])
    assert single["c0"] == "000010"


BAD = [
    "$.num + 1", "abs($.num)", "CAST ($.num AS INT)", "cast($.num as date)", "subString($.id, 1, 9)", "1 / ($.zero - 0)", "$.big + 1", "concat('a', CAST($.num AS INT))",
    "if $.id == 'o1' then CAST($.num AS INT) else 0", "coalesce(nullif($.gone, ''), CAST($.num AS INT))", "date_add($.num, 1)",
]
GOOD = [
    "$.gone + 1", "CAST($.gone AS INT)", "TRY_CAST($.num AS INT)", "if $.id == 'no' then CAST($.num AS INT) else 0", "coalesce($.zero, CAST($.num AS INT))", "$.num > 5",
    "CASE WHEN $.id = 'o1' THEN 1 WHEN CAST($.num AS INT) = 1 THEN 2 END",
]


def test_bad_values_reject_their_message(spark):
    doc = {**ORDER, "zero": "0", "big": "9223372036854775807"}
    got = mapped_cells(spark, doc, [*BAD, *GOOD, "$.id"])
    assert got.rows.count() == 0
    assert got.rejects.first()["failed"].split(",") == [f"c{i}" for i in range(len(BAD))]
    assert got.doc_ids.first()["doc_id"] == "o1"
    kept = mapped_cells(spark, doc, [*GOOD, "$.id"])
    assert kept.rejects.count() == 0 and kept.rows.count() == 1
    as_null = mapped_cells(spark, doc, [*BAD, "$.id"], badValues="null")
    assert as_null.rows.first()["cells"] == {f"c{len(BAD)}": "o1"} and as_null.rejects.count() == 0


def test_only_templates_that_apply_can_fail(spark):
    assert mapped_cells(spark, ORDER, ["$.num + 1"], when="$.id == 'other'").rejects.count() == 0
    assert mapped_cells(spark, ORDER, ["$.id"], when="CAST($.num AS INT) = 1").rejects.first()["failed"] == "when"
    broken = mapped_cells(spark, "{no", ["$.num + 1"])
    assert [tuple(r) for r in broken.rejects.collect()] == [("t", "{no", None)]


def test_a_child_s_bad_value_rejects_the_message(spark):
    spec = {
        "sourceMap": [{"sourceName": "s", "when": "true", "templates": ["t"], "idockey": ["$.id"], "sortkey": ["$.stamp + 0"]}],
        "templates": [
            {"name": "t", "row": {"name": "T", "rowKey": ["$.id"], "cols": [{"name": "id", "value": "$.id"}]}, "children": [{"template": "kid", "select": "$.l"}]},
            {"name": "kid", "row": {"name": "K", "rowKey": ["../$.id"], "cols": [{"name": "q", "value": "CAST($.q AS INT) + ../$.add"}]}, "children": [{"template": "leaf", "select": "$.x"}]},
            {"name": "leaf", "row": {"name": "L", "rowKey": ["../../$.id"], "cols": [{"name": "u", "value": "subString($.u, 0, 1)"}]}},
        ],
    }
    docs = [
        {"id": "1", "stamp": "1", "add": "1", "l": [{"q": "1"}, {"q": "2", "x": [{"u": "uu"}]}]},
        {"id": "2", "stamp": "1", "add": "1", "l": [{"q": "1"}, {"q": "two"}]},
        {"id": "3", "stamp": "1", "add": "1", "l": [{"q": "1", "x": {"u": "u"}}, {"q": "1", "x": [{"u": "u"}, {"u": ""}]}]},
        {"id": "4", "stamp": "x", "add": "1", "l": []},
    ]
    frame = spark.createDataFrame([("t", json.dumps(d)) for d in docs], "topic string, value string")
    got = mapping.map_documents(frame, spec)
    assert sorted((r["table_name"], *r["cells"].values()) for r in got.rows.collect()) == [("K", "2"), ("K", "3"), ("L", "u"), ("T", "1")]
    assert sorted((json.loads(r["value"])["id"], r["failed"]) for r in got.rejects.collect()) == [("2", "q"), ("3", "u"), ("4", "sortkey")]


def test_settings_are_put_back(spark):
    before = [spark.conf.get(k, None) for k in ("spark.sql.ansi.enabled", "spark.sql.legacy.sizeOfNull")]
    mapped_cells(spark, ORDER, BAD)
    assert [spark.conf.get(k, None) for k in ("spark.sql.ansi.enabled", "spark.sql.legacy.sizeOfNull")] == before


def test_paths_read_a_value_once_for_all_its_elements(spark):
    """Bounds of a slice and depths of a descent are worked out once for a value, and give the same matches."""
    items = list(range(7))
    doc = spark.createDataFrame([(json.dumps({"a": items, "b": {"x": [{"n": [1]}, {"n": 2, "t": "[{"}]}}),)], "v string")
    df = doc.select(F.try_parse_json("v").alias("doc"))
    a = jp.path(F.col("doc")).field("a")
    for start, stop, step in [(None, None, 1), (1, 3, 1), (-2, None, 1), (2, 1, 1), (-9, -2, 2), (0, 99, 3), (8, 9, 1), (1, -9, 1)]:
        low = max(0, start if start is None or start >= 0 else 7 + start) if start is not None else 0
        high = 7 if stop is None else stop if stop >= 0 else 7 + stop
        want = [x for i, x in enumerate(items) if low <= i < high and (i - low) % step == 0]
        assert df.select(a.slice(start, stop, step).joined(",")).first()[0] == ",".join(map(str, want))
    cut = df.select(a.slice(1, 3).joined(","))._jdf.queryExecution().analyzed().toString()
    assert cut.count("array<variant>") + cut.count("ArrayType(VariantType") <= 2
    deep = jp.path(F.col("doc"))
    assert df.select(deep.deep_field("n").joined(","), deep.deep_any().count()).first()[:] == ("[1],2", 7)
    assert "concat(" not in df.select(deep.deep_any().count())._jdf.queryExecution().analyzed().toString()


def test_a_child_s_texts_are_read_once(spark):
    """A text of a child is read once, whatever uses it: cells, keys, or its own children."""
    line = {"name": "line", "row": {"name": "l", "colFamily": "f", "rowKey": ["$.n"], "cols": [{"name": "n", "value": "$.n", "isDedup": True}, {"name": "s", "value": "$.s"}]}, "children": [{"template": "part", "select": "$.p"}]}
    part = {"name": "part", "row": {"name": "p", "colFamily": "f", "rowKey": ["../$.n", "$.k"], "cols": [{"name": "k", "value": "$.k"}, {"name": "up", "value": "concat('n', ../$.n)"}]}}
    order = {"name": "order", "row": {"name": "o", "colFamily": "f", "rowKey": ["$.id"], "cols": []}, "children": [{"template": "line", "select": "$.lines"}]}
    spec = {"templates": [order, line, part], "sourceMap": [{"sourceName": "all", "templates": ["order"], "when": "true", "idockey": ["$.id"]}]}
    plan = mapping.mapping_plan(spec, mapping.Scope(spark))
    assert plan.rows.count("'$.n'") == 1 and plan.rows.count("'$.k'") == 1
    docs = ['{"id": 1, "lines": [{"n": 1, "s": "x", "p": {"k": 7}}, {"n": 2, "p": [{"k": 8}, {"k": null}]}, {"p": null}]}', '{"id": 2, "lines": {"n": 3}}', '{"id": 3, "lines": null}']
    frame = spark.createDataFrame([("t", d) for d in docs], "topic string, value string")
    got = sorted((r["table_name"], r["row_key"], tuple(sorted(r["cells"].items()))) for r in mapping.map_documents(frame, spec).rows.collect())
    assert got == [
        ("l", "1", (("n", "1"), ("s", "x"))),
        ("l", "2", (("n", "2"),)),
        ("l", "3", (("n", "3"),)),
        ("p", "1-7", (("k", "7"), ("up", "n1"))),
        ("p", "2-8", (("k", "8"), ("up", "n2"))),
        ("p", "2-?", (("up", "n2"),)),
        ("p", "?-?", (("up", "n"),)),
    ]
