"""Language, quality, toxicity and nearest neighbours: exact parts against plain twins, learned ones on held-out rows."""

import os
import random
from bisect import bisect_left

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.llm import hamming, language, quality, stats, toxicity
from flowframe.llm.common import fold, least_hashed
from flowframe.llm.queries import QUERIES
from tests.llm.cases import distance, odd

DATA = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_language(spark):
    english = "the cat and the dog were sitting in the house with their friends and a book"
    german = "der Hund und die Katze saßen mit ihren Freunden im Haus und lasen ein Buch"
    rows = [(100 + i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(40)]
    docs = odd(spark, rows)
    profiles = language.learn_profiles(docs, F.lit(True))
    assert list(profiles) == ["de", "en", "ja"]
    got = {(r["doc_id"], r["text"]): r for r in language.identify(docs, profiles).collect()}
    assert {i for (i, _), r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3, 8}
    assert got[(101, english)]["lang_pred"] == "en" and got[(100, german)]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[(1, None)]["score"] == 0 and "score" in docs.columns
    kept = language.accepted(docs.drop("score"), profiles)
    assert kept.columns == docs.drop("score").columns and kept.where("doc_id IN (1, 2, 3, 8)").count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.identify(docs.limit(0), profiles).count() == 0
    assert language.learn_profiles(docs.limit(0), F.lit(True)) == {}


def test_language_is_learned_from_all_labelled_rows(spark):
    """Profiles and least cosines are those of every labelled row, also beyond a thousand of a language."""
    r = random.Random(3)
    rows = [(i, "".join(r.choice("abcdefg hij ") for _ in range(r.randint(20, 400))), "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5, "doc_id")
    space, total = language.Space(language.DIM, language.GRAM), np.zeros(language.DIM)
    vectors = {i: space.counted(t) for i, t, _ in rows}
    for v, _ in vectors.values():
        total += v / np.linalg.norm(v)
    profiles = language.learn_profiles(docs, F.lit(True))
    assert np.allclose(profiles["en"], total / np.linalg.norm(total), atol=1e-12)
    by_size = {}
    for v, n in vectors.values():
        by_size.setdefault(int(np.log2(n)), []).append(float(profiles["en"] @ v / np.linalg.norm(v)))
    want = {k: (np.quantile(v, language.QUANTILE) + language.NOISE / language.DIM**0.5) / 2 for k, v in by_size.items() if len(v) >= language.LEAST_TEXTS}
    got = language.learn_least(docs, F.lit(True), profiles)
    assert want and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_language_vectors():
    space = language.Space(64, 3)
    text = "ab ab"
    grams = [" ab", "ab ", "b a", " ab", "ab "]
    want = np.zeros(64)
    for g in grams:
        v = np.ones(64)
        for place, c in enumerate(reversed(g)):
            v *= np.roll(space.letter(0 if c == " " else ord(c)), place)
        want += v
    assert (space.vector(text) == want).all()


@needs_data
@pytest.mark.parametrize("name,column,least", [("op8_language", "lang", 0.97), ("op5_quality", "quality", 0.9), ("op9_toxicity", "toxic", 0.8)])
def test_held_out_rows(spark, name, column, least):
    got = {r["doc_id"]: r for r in QUERIES[name](spark, DATA).collect()}
    table = "documents" if column == "lang" else "labels"
    truth = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{DATA}/{table}.parquet").collect()}
    rows = [(got[i], y) for i, y in truth.items() if got[i]["held_out"]]
    right = [(r["lang_pred"] if column == "lang" else r["predicted"]) == y for r, y in rows]
    assert sum(right) / len(right) >= least
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_folds(spark):
    ids = [0, 1, 17, 123456789, -5]
    import zlib

    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(fold(F.col("doc_id"), 4)).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 4 for i in ids]


def test_isotonic():
    r = np.random.default_rng(0)
    x, w = np.arange(30.0), r.integers(1, 5, 30).astype(float)
    y = np.clip(x / 30 + r.normal(0, 0.3, 30), 0, 1)
    knots, levels = quality.isotonic(x, w, w * y)
    fitted = levels[[max(0, bisect_left(block_ends(knots, x, w), i)) for i in range(30)]]
    means = np.array([[(w[i : j + 1] * y[i : j + 1]).sum() / w[i : j + 1].sum() if j >= i else np.nan for j in range(30)] for i in range(30)])
    minimax = [max(min(means[i, j] for j in range(k, 30)) for i in range(k + 1)) for k in range(30)]
    assert (np.diff(levels) > 0).all()
    assert np.allclose(fitted, minimax)


def block_ends(knots, x, w):
    """The last place of each block, from its weighted mean place."""
    ends, at = [], 0
    for k in knots:
        for end in range(at, len(x)):
            if np.isclose((x[at : end + 1] * w[at : end + 1]).sum() / w[at : end + 1].sum(), k):
                ends.append(end)
                at = end + 1
                break
    return ends


def test_quality(spark):
    rows = [(100 + i, f"An ordinary sentence, number {i}, that says a few things about the world." if i % 2 else "$$$ ### !! " * (i % 9 + 1)) for i in range(400)]
    docs = odd(spark, rows)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(400)] + [(None, 1), (1, None), (999_999, 1)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] >= 100]
    assert all(r["predicted"] == r["doc_id"] % 2 for r in held) and held
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert (stats.text_stats(" \n") == 0).all()


def test_held_out_labels_are_not_read(spark):
    docs = odd(spark, [(100 + i, "plain words here" if i % 2 else "$$$ ###") for i in range(200)])
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(200)], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = ({r["doc_id"]: r["score"] for r in quality.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert first == pytest.approx(second, abs=1e-9)


def test_automaton():
    r = random.Random(2)
    words, stems = ["idiot", "moron", "scum", "trashy", "idiom"], ["lowei", "veq"]
    a = toxicity.build_automaton(words, stems)
    tried = {"idiot", "moron", "scum", "sum", "loweinz", "lowez", "veq", "ve", "idioms", "idot", "xidiot", "trashyy"}
    for _ in range(1500):
        w = list(r.choice([*words, *stems]))
        for _ in range(r.randint(0, 2)):
            at = r.randrange(len(w) + 1)
            if r.random() < 0.4:
                w.insert(at, r.choice("abimoz"))
            elif w:
                w[min(at, len(w) - 1) : min(at, len(w) - 1) + 1] = r.choice(["", "a", "o"])
        tried.add("".join(w))
    for w in tried:
        _, _, code = toxicity.run_automaton(a, toxicity.latin(w))
        exact = [i for i, t in enumerate(words) if t == w]
        near = [i for i, t in enumerate(words) if len(t) >= 5 and distance(t, w) == 1]
        stem = any(w.startswith(s) for s in stems)
        if stem:
            assert len(code) == 1 and (code[0] - 1) // 2 >= len(words)
        elif exact:
            assert code.tolist() == [2 * exact[0] + 1]
        elif near:
            assert len(code) == 1 and (code[0] - 1) // 2 in near and code[0] % 2 == 0
        else:
            assert len(code) == 0, w


def test_places_and_quotes():
    a = toxicity.build_automaton(["idiot"], ["vequ"])
    data = toxicity.latin('You IDIOT! He was called an idiot. “idiot” vequilla idiotic')
    start, length, code = toxicity.run_automaton(a, data)
    assert [data[s : s + n].decode() for s, n in zip(start, length)] == ["idiot", "idiot", "idiot", "vequ"]
    assert [toxicity.quoted(data, s, n) for s, n in zip(start, length)] == [False, True, True, False]
    assert code.tolist() == [1, 1, 1, 3]


def test_toxicity(spark):
    r = random.Random(5)
    filler = [f"{x}{y}{z}" for x in "bcdfg" for y in "aeiou" for z in "lmnr"]

    def text(bad):
        words = [r.choice(filler) for _ in range(40)]
        if bad:
            words[r.randrange(40)] = r.choice(["wretchedone", "vilething"])
        return " ".join(words)

    docs = odd(spark, [(100 + i, text(i % 4 == 0)) for i in range(600)] + [(2000, "bal wretchedonne cel"), (2001, "")])
    labels = spark.createDataFrame([(100 + i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {g["doc_id"]: g for g in toxicity.toxicity_report(docs, labels).collect()}
    for i in range(600):
        assert got[100 + i]["predicted"] == int(i % 4 == 0)
    assert got[2000]["n_hits"] == 1 and got[2000]["score"] > got[2001]["score"]
    assert toxicity.toxicity_report(docs, labels).count() == docs.count()
    nothing = toxicity.toxicity_report(docs, labels.limit(0))
    assert {round(x["score"], 6) for x in nothing.collect()} == {0.5} and nothing.count() == docs.count()
    assert toxicity.toxicity_report(docs.limit(0), labels).count() == 0


def test_pigeonhole():
    r = np.random.default_rng(1)
    codes = r.integers(0, 256, (500, 4), dtype=np.uint8)
    block = hamming.Block(codes)
    for q in codes[:40]:
        d = np.unpackbits(codes ^ q, axis=1).sum(1)
        for radius in (0, 3, 4, 7, 11, 16, 32):
            assert block.within(q, radius).tolist() == np.flatnonzero(d <= radius).tolist()


def exact_neighbours(rows, queries, k=20):
    ids = sorted(rows)
    out = {}
    for q in queries:
        scored = sorted((-float((np.array(rows[i], dtype=float) * np.array(rows[q], dtype=float)).sum()), i) for i in ids if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_neighbours(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(8, 16))
    rows = {i: (centres[i % 8] + 0.4 * r.normal(size=16)).astype(np.float32).tolist() for i in range(600)}
    rows.update({i: rows[0] for i in range(600, 760)})  # one vector of many rows
    bad = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] + [1.0] * 15), (1060, [None] + [1.0] * 15), (1080, [1.0]), (None, rows[1])]
    df = spark.createDataFrame([*rows.items(), *bad, (5, rows[5])], "vec_id long, embedding array<float>")
    is_query = F.pmod(F.col("id"), F.lit(20)) == 0
    got = hamming.nearest_by_inner_product(df, "vec_id", "embedding", is_query, block_rows=200, query_rows=16).collect()
    want = exact_neighbours(rows, [i for i in rows if i % 20 == 0])
    found = {}
    for g in sorted(got, key=lambda g: (g["query_id"], g["rank"])):
        assert g["score"] == pytest.approx(float(np.dot(np.array(rows[g["query_id"]], float), np.array(rows[g["vec_id"]], float))), abs=1e-9)
        found.setdefault(g["query_id"], []).append(g["vec_id"])
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    assert sum(len(set(found[q]) & set(want[q])) for q in want) >= 0.95 * 20 * len(want)
    few = hamming.nearest_by_inner_product(df.where("vec_id < 3"), "vec_id", "embedding", is_query).collect()
    assert sorted((g["query_id"], g["vec_id"]) for g in few) == [(0, 1), (0, 2)]
    assert hamming.nearest_by_inner_product(df.limit(0), "vec_id", "embedding", is_query).count() == 0


@needs_data
def test_recall(spark):
    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    want = exact_neighbours(rows, [i for i in rows if i % 20 == 0])
    found = {}
    for g in QUERIES["op2_hamming_neighbours"](spark, DATA).collect():
        found.setdefault(g["query_id"], set()).add(g["vec_id"])
    assert sum(len(found[q] & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("spread", [0.0, 0.5, 1.0])
def test_recall_of_a_full_block_of_any_lengths(spread):
    """Where most of the codes are left out, and long vectors beat those in a better direction."""
    r = np.random.default_rng(7)
    v = r.normal(size=(hamming.BLOCK_ROWS, 64))
    v = v / np.linalg.norm(v, axis=1, keepdims=True) * np.exp(spread * r.normal(size=(len(v), 1)))
    ids, q = np.arange(len(v)), np.arange(0, len(v), 80)
    a, b, _ = hamming.search_block(hamming.learn_codes(v[:4096]), ids, v, q, v[q])
    s = v[q] @ v.T
    s[np.arange(len(q)), q] = -np.inf
    best = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(set(b[a == i]) & set(w)) / 20 for i, w in zip(q, best)]) >= 0.9


def test_bands_hold_every_row():
    lengths = np.exp(np.random.default_rng(3).normal(size=500))
    for given in (lengths, np.ones(7), lengths[:1], lengths[:0]):
        groups = hamming.bands(given)
        assert sorted(np.concatenate(groups).tolist() if groups else []) == list(range(len(given))) and len(groups) <= hamming.BANDS


def test_disguised_and_very_long_terms():
    a = toxicity.build_automaton(["idiot", "moron", "w" * 1500], ["scum"])
    hits = lambda t: [(int(s), int(n)) for s, n, _ in zip(*toxicity.run_automaton(a, toxicity.latin(t)), strict=True)]
    for word in ("id1ot", "mor*n", "idi0t", "m0ron", "idiot"):
        assert hits(f"you {word}!") == [(4, 5)]
    assert hits("x idiot-moron y") == [(2, 5), (8, 5)]  # parts are words of their own
    assert hits("a 1diot") == [(3, 4)] and hits("3 4-5 a.b c1") == [] and hits("i*d*iot") == []
    assert hits("w" * 1500) == [(0, 1500)] and hits("scumbag1x") == [(0, 4)]


def test_samples_of_least_hashes(spark):
    """The same rows whether others go in the scan or not."""
    df = spark.range(4000).withColumnRenamed("id", "doc_id").repartition(7)
    best = [r["doc_id"] for r in df.orderBy(F.xxhash64("doc_id")).limit(300).collect()]
    assert [r["doc_id"] for r in least_hashed(df, "doc_id", 300).collect()] == best
    assert least_hashed(df, "doc_id", 9000).count() == 4000 and least_hashed(df.limit(0), "doc_id", 3).count() == 0
    docs = df.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, "b").otherwise("a")).withColumn("text", F.lit("t"))
    got = language._labelled(docs, F.lit(True), 100).groupBy("lang").count().collect()
    assert sorted(map(tuple, got)) == [("a", 100), ("b", 100)]
