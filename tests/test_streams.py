"""Streams with state, and micro-batches in one look, against their batch forms."""

import json
import random

from pyspark.sql import functions as F

from flowframe.operators import cells, mapping
from flowframe.streaming import batches, files
from flowframe.streaming.upserts import upsert_stream
from tests.helpers import rows

SCHEMA = "row_key string, ts bigint, dedup_key string, n int"


def test_the_stream_lets_through_what_batches_would(spark, tmp_path):
    r = random.Random(8)
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    history, want, number = spark.createDataFrame([], SCHEMA), [], 0
    for part in range(4):
        given = []
        for _ in range(80):
            number += 1
            key = r.choice(["a", "a", "a", "b", "c", None])
            given.append((key, number if r.random() < 0.9 else number - 40, r.choice(["x", "y", "z", "w", "v", "", None]), number))
        batch = spark.createDataFrame(given, SCHEMA).coalesce(1)
        batch.write.mode("append").json(path)
        # the batch form joins on the key, so rows without one are compared as a key of their own here
        keyed = lambda df: df.withColumn("row_key", F.coalesce("row_key", F.lit("-")))
        passed = cells.upsert_with_lookback(keyed(history.withColumn("dedup_key", F.coalesce("dedup_key", F.lit("")))), keyed(batch), 3)
        ids = rows(passed, "n")
        want += ids
        history = history.union(batch.where(F.col("n").isin([i for i, in ids])))
        stream = files.file_stream(spark, path, "json", SCHEMA, pattern="*.json")
        batches.run_batches(upsert_stream(stream, 3), lambda df, i: batches.write_batch(df, out, i), state).awaitTermination()
    assert sorted(rows(spark.read.parquet(out), "n")) == sorted(want) and len(want) < number - 30


SPEC = {
    "templates": [{"name": "t", "row": {"name": "T", "rowKey": ["$.id"], "colFamily": "f", "cols": [{"name": "q", "value": "$.q + 1"}, {"name": "topic", "value": "topic"}]}}],
    "sourceMap": [{"sourceName": "s", "when": "$.kind == 'k'", "templates": ["t"], "idockey": ["$.id"], "sortkey": ["$.id"]}],
}
MESSAGES = [
    {"id": "1", "kind": "k", "q": "1", "at": "5", "h": {"t": "one"}},
    {"id": "2", "kind": "k", "q": "two", "at": "4", "h": {"t": "one"}},
    {"id": "3", "kind": "other", "q": "3", "at": "3"},
    {"id": "4", "kind": "k", "q": "4", "at": "late", "h": {"t": "two"}},
    {"id": "5", "kind": "k", "q": "5", "h": {"t": "two"}},
]


def messages(spark):
    texts = [json.dumps(m) for m in MESSAGES]
    lines = ["\n".join(texts[:2]), *texts[2:], "{broken", ""]
    return spark.createDataFrame([("given", t) for t in lines], "topic string, value string")


def test_one_look_gives_the_frames_of_a_mapping(spark):
    one, apart = mapping.split_tagged(mapping.map_tagged(messages(spark), SPEC)), mapping.map_documents(messages(spark), SPEC)
    for name in ("rows", "doc_ids", "rejects"):
        a, b = getattr(one, name), getattr(apart, name)
        a = a.drop("order")
        assert a.columns == b.columns
        assert sorted(str(r.asDict(True)) for r in a.collect()) == sorted(str(r.asDict(True)) for r in b.collect())


def test_topics_and_order_of_messages(spark):
    tagged = mapping.map_tagged(messages(spark).drop("topic"), SPEC, topic="$.h.t", sort_path="$.at")
    got = mapping.split_tagged(tagged)
    assert [(r["topic"], r["order"], r["row_key"], r["cells"]["topic"]) for r in got.rows.collect()] == [("one", 5, "1", "one")]
    assert sorted((json.loads(r["value"])["id"] if r["value"][1] == '"' else r["value"], r["topic"], r["failed"]) for r in got.rejects.collect()) == [
        ("2", "one", "q"), ("4", "two", "sort"), ("5", "two", "sort"), ("{broken", None, None)
    ]
    assert sorted((r["topic"], r["doc_id"]) for r in got.doc_ids.collect()) == [("one", "1"), ("one", "2"), ("unknown", "3")]
    audit = {r["topic"]: (r["messages"], r["rows"], r["documents"], r["rejected"]) for r in batches.tagged_audit(tagged, 3).collect()}
    assert audit == {"one": (2, 1, 2, 1), "two": (2, 0, 0, 2), "unknown": (1, 0, 1, 0), None: (1, 0, 0, 1)}
    assert {r["topic"] for r in mapping.map_tagged(messages(spark), SPEC, topic="fixed").collect()} == {"fixed"}
