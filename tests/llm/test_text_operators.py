"""Mixing, archives, packing, lines, n-grams and rules against plain twins, with odd rows."""

import gzip
import io

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowframe.llm import lines, mixing, ngrams, packing, rules, warc
from flowframe.llm.graph import components
from flowframe.llm.queries import QUERIES
from tests.llm.cases import WORD, base_counts, distance, find_components, gram_set, odd


def shared_targets(sizes, weights, most):
    """Resharing step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = float(sum(sizes.values())), {}
    while True:
        rest = {s: weight[s] for s in names if s not in full}
        share = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return {**share, **full}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i:02}": r.choice([0, 3, 10, 1000, 50_000]) for i in range(9)} | {None: 40, "a": 1}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    want = shared_targets(sizes, mixing.WEIGHTS, 3.0)
    for row in mixing.source_targets(df).collect():
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(want[row["source"]], rel=1e-9, abs=1e-6)


def test_mix(spark):
    rows = [(i, "word " * (i % 40 + 1), "en", "big" if i % 3 else f"s{i % 7}") for i in range(900)]
    docs = odd(spark, rows)
    plan = {(r["doc_id"], r["text"]): r for r in mixing.mix_plan(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = {(r["doc_id"], r["text"]): r["n"] for r in mixed.groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    assert all(got.get(k, 0) == r["_copies"] * (2 if k[0] == 5 and k[1][0] == "Z" else 1) for k, r in plan.items())
    report = mixing.mix_report(docs).collect()
    assert len(report) == docs.count() and {tuple(r) for r in report} == {tuple(r) for r in mixing.mix_report(docs).collect()}
    taken = {}
    for r in report:
        assert r["taken"] <= 3 * r["size"]
        taken[r["target"]] = taken.get(r["target"], 0) + r["taken"]
    assert any(abs(t - n) <= 0.02 * t for t, n in taken.items() if t > 1000)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_archives(spark):
    same = "x" * 150
    rows = [(9, "u9", same), (3, "u3", same), (4, "u\r\n4", "y" * 20), (5, "u5", "y" * 20), (6, None, None), (3, "again", same)]
    rows += [(None, "none", same), (7, "", ""), (8, "long", "é" * 3_000_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    got = warc.archive_and_read(spark, pages).collect()
    assert all(r["status"] == "ok" for r in got)
    want = {
        (i, len((h or "").encode()), "revisit" if h == same and i != 3 else "response", 3 if h == same and i != 3 else None) for i, _, h in rows
    }
    assert len(got) == len(rows)
    assert {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got} == want
    assert warc.archive_and_read(spark, pages.limit(0)).count() == 0


def test_broken_archives(spark, tmp_path):
    records = [warc.record_bytes(i, f"u{i}", f"page {i}".encode() * 50, None, "2024-01-01T00:00:00Z") for i in range(4)]
    good = [warc.member(r) for r in records]
    assert gzip.decompress(good[0]) == records[0]
    wrong = warc.member(records[1].replace(b"page 1", b"page 9", 1))
    short = warc.member(records[2][:-40])
    files = {
        "whole": (b"".join(good) + b"\0" * 9, ["ok"] * 4),
        "digest": (good[0] + wrong + good[3], ["ok", "bad_digest", "ok"]),
        "frame": (good[0] + short + good[3], ["ok", "bad_frame", "ok"]),
        "cut": (good[0] + good[1][:-20], ["ok", "bad_frame"]),
        "noise": (good[0] + b"no gzip", ["ok", "bad_frame"]),
        "empty": (b"", []),
    }
    for name, (data, _) in files.items():
        (tmp_path / name).write_bytes(data)
    manifest = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in files], "archive string")
    got = warc.read_warc(manifest).orderBy("archive", "position").collect()
    for name, (_, statuses) in files.items():
        assert [r["status"] for r in got if r["archive"].endswith("/" + name)] == statuses
    assert [d for _, d in warc.members(io.BytesIO(b"".join(good)), chunk=7)] == records


def test_packing(spark):
    docs = odd(spark, [(100 + i, "some words of text " * (i * 13 % 170), "en", "s") for i in range(60)])
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    pieces = packing.pack(docs.repartition(5)).collect()
    for r in pieces:
        ids = np.array(want[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert (len(ids), zlib.crc32(ids.tobytes()), len(want[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
    total = sum(len(want[r["doc_id"]]) for r in docs.select("doc_id").collect())
    assert sum(r["length"] for r in pieces) == total
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by_sequence) == list(range(-(-total // 2048)))
    for s, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or s == max(by_sequence)
    assert packing.pack(docs.limit(0)).count() == 0


def test_both_encoders_agree():
    ids, tok = packing._tokenizer("byte_bpe_50k.json"), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd_texts = ["", " ", "a  b\n\n c\t", "it's we'll I'D", "x<|endoftext|>y", "naïve café ñandú", "日本 ok", "1234 5,6", "\x1c\x85\xa0nbsp", "ſ ƒ Ǆ"]
    assert ids(odd_texts) == [tok.encode(t, add_special_tokens=False).ids for t in odd_texts]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60))
def test_latin_texts_encode_alike(text):
    ids, tok = packing._tokenizer("byte_bpe_50k.json"), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids([text]) == [tok.encode(text, add_special_tokens=False).ids]


def edited(r, text, n):
    out = list(text)
    for _ in range(n):
        at = r.randrange(len(out) + 1)
        kind = r.random()
        if kind < 0.34:
            out.insert(at, r.choice("abé "))
        elif out:
            at = min(at, len(out) - 1)
            if kind < 0.67:
                out.pop(at)
            else:
                out[at] = r.choice("abé ")
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    r = random.Random(edits)
    pairs = []
    for _ in range(300):
        a = "".join(r.choice("abé ") for _ in range(r.randint(4, 40)))
        pairs.append((a, edited(r, a, r.randint(0, edits + 2))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for a, b, d in df.select("a", "b", lines.banded_distance(F.col("a"), F.col("b"), edits)).collect():
        assert d == distance(a, b) if distance(a, b) <= edits else d > edits


@pytest.mark.parametrize("seed", range(2))
def test_lines(spark, seed):
    r = random.Random(seed)
    bases = ["".join(r.choice("abcdefé ") for _ in range(r.randint(18, 40))) + "z" for _ in range(12)]
    rows = [(100 + i, "\n".join(edited(r, r.choice(bases), r.choice([0, 0, 1, 2, 3])) for _ in range(4)) + "\nshort\n\n", "en", "s") for i in range(60)]
    docs = odd(spark, rows)
    seen = {}
    for d in docs.collect():
        for i, x in enumerate((d["text"] or "").split("\n")):
            if len(x) >= 20 and WORD.search(x):
                seen[(d["doc_id"] if d["doc_id"] is not None else 2**63 - 1, i)] = x
    first = {}
    for k in sorted(seen):
        first.setdefault(seen[k], k)
    near = {x: [y for y in first if x != y and abs(len(x) - len(y)) <= 2 and distance(x, y) <= 2] for x in first}
    assert any(near.values())
    want = {}
    for k, x in seen.items():
        early = min((first[y] for y in near[x] if first[y] < first[x]), default=None)
        want[k] = (first[x], len(near[x]), early, first[x] == k and early is None)
    got = {}
    for g in lines.judged_lines(docs).collect():
        k = (g["doc_id"] if g["doc_id"] is not None else 2**63 - 1, g["line_no"])
        got[k] = ((g["first_doc"], g["first_line"]), g["n_links"], None if g["near_doc"] is None else (g["near_doc"], g["near_line"]), g["kept"])
    assert got == want
    clean = lines.dedup_lines(docs)
    assert clean.columns == docs.columns
    for d in clean.collect():
        before = next(x["text"] for x in rows_of(docs) if x["doc_id"] == d["doc_id"])
        if before:
            key = d["doc_id"] if d["doc_id"] is not None else 2**63 - 1
            assert d["text"] == "\n".join(x for i, x in enumerate(before.split("\n")) if want.get((key, i), (0, 0, 0, True))[3])
    kept_ids = {d["doc_id"] for d in clean.collect()}
    assert {1, 2, 3, 4, 6, None} <= kept_ids
    assert lines.judged_lines(docs.limit(0)).count() == 0 and lines.dedup_lines(docs.limit(0)).count() == 0


def test_lines_two_edits_apart(spark, tmp_path):
    """Every pair of edits at every place: a substitution, deletion or insertion, also across a step of lengths."""
    base = "".join(chr(97 + i % 26) if i % 3 else chr(0x4E00 + i) for i in range(22))
    kinds = [(k, i) for k in "sdi" for i in range(0, 23, 2)]
    texts = [base]
    for x, (k, i) in enumerate(kinds):
        for q, j in kinds[x:]:
            out = list(base)
            for kind, at in sorted([(k, i), (q, j)], key=lambda e: -e[1]):
                out[at : at + (kind != "i")] = [] if kind == "d" else ["#"]
            texts.append("".join(out))
    texts = [t for t in dict.fromkeys(texts) if len(t) >= 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = {r["doc_id"] for r in lines.judged_lines(docs).where("near_doc = 0").collect()}
    assert linked == {i for i, t in enumerate(texts) if i and distance(t, base) <= 2} and len(linked) > 300
    pair = ["a line of the corpus that comes twice", "a lime of the corpus that comes twyce"]
    spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r["kept"] for r in sorted(QUERIES["op4_line_dedup"](spark, str(tmp_path)).collect())] == [True, False]


def test_lines_of_null_and_repeated_ids(spark):
    """Rows without an id, and different texts under one id, don't share verdicts."""
    common, own = "this line stands in several of the documents", "only {} has this particular sentence, {}"
    texts = {k: own.format(k * 4, k[::-1] * 3) for k in ("alpha", "bravo", "delta", "gamma", "kappa")}
    rows = [
        (1, common),
        (None, f"{common}\n{texts['alpha']}"),
        (None, texts["bravo"]),
        (7, f"{common}\n{texts['delta']}"),
        (7, f"{texts['gamma']}\n{texts['kappa']}"),
    ]
    clean = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, common), (None, texts["alpha"]), (None, texts["bravo"]), (7, texts["delta"]), (7, rows[4][1])]
    assert sorted(map(tuple, clean), key=str) == sorted(want, key=str)
    alike = [(None, f"{common}\n{x}") for x in texts.values()]
    clean = lines.dedup_lines(spark.createDataFrame(alike, "doc_id long, text string")).collect()
    assert sum(common in r["text"] for r in clean) == 1 and all(any(x in r["text"] for r in clean) for x in texts.values())


def rows_of(df):
    return df.collect()


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == find_components({n for p in links for n in p}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates(spark, seed, monkeypatch):
    monkeypatch.setattr(ngrams, "COLUMN_ROWS", 8)  # so that large columns are cut here as well
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdef" for b in "xyz"] + ["É", "the"]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(3, 90))] for _ in range(8)]
    rows = []
    for i in range(140):
        words = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            words[r.randrange(len(words))] = r.choice(vocabulary).upper()
        rows.append((1000 + i, r.choice([" ", "\n", "\t "]).join(words), "en", "s"))
    docs = odd(spark, rows)
    sets = {}
    for d in docs.where("doc_id IS NOT NULL").collect():
        sets[d["doc_id"]] = gram_set(d["text"])
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and 100 * both >= 85 * union and both:
                links.append((a, b))
    want = find_components(ids, links)
    assert len(set(want.values())) < len(ids)
    found = ngrams.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    for g in found:
        if g["doc_id"] is None:
            assert g["component_id"] is None
        else:
            assert (g["n_shingles"], g["component_id"]) == (len(sets[g["doc_id"]]), want[g["doc_id"]])
    kept = ngrams.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(k["doc_id"] for k in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id IS NULL").count() == 1
    assert ngrams.near_duplicates(docs.limit(0)).count() == 0 and ngrams.keep_one(docs.limit(0)).count() == 0


def test_gram_sets_in_pieces(monkeypatch):
    texts = [" ".join(f"Word{i * j % 50}" for i in range(j)) for j in (0, 1, 3, 4, 5, 400)] + ["", "  \n"]
    whole = [s.tolist() for s in ngrams.gram_sets(texts)]
    monkeypatch.setattr(ngrams, "_CHUNK", 37)
    assert [s.tolist() for s in ngrams.gram_sets(texts)] == whole
    assert [len(s) for s in whole] == [len(gram_set(t)) for t in texts]


def test_rules(spark):
    good = [(i, " ".join(f"word{i * j % 17}" for j in range(80)), "en", "s") for i in range(100, 130)]
    bad = [(i, " ".join(f"$$junk{j}##" for j in range(80)), "en", "s") for i in range(200, 230)]
    rows = [*good, *bad, (300, "a b c d\na b c d\nx\n\n x\nx", "en", "s"), (301, "same words again " * 40, "en", "s")]
    docs = odd(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i in range(100, 130)] + [(200, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = rules.quality_rules(docs, labels).collect()
    assert len(got) == docs.count()
    texts = {d["doc_id"]: d["text"] for d in docs.collect()}
    for g in got:
        counts = base_counts(texts[g["doc_id"]])
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert g["base_failed"] == failed and (g["kept"] is False if failed else g["kept"] == (g["mean_ratio"] >= rules.LEAST_RATIO))
    by_id = {g["doc_id"]: g for g in got}
    assert all(by_id[i]["mean_ratio"] > by_id[j]["mean_ratio"] for i in (110, 120) for j in (210, 220))
    assert not by_id[210]["kept"]
    assert rules.quality_rules(docs.limit(0), labels).count() == 0
    assert {g["mean_ratio"] for g in rules.quality_rules(docs, labels.limit(0)).collect()} == {0.0}




def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    """Components are known as soon as the links are stars; no round is spent on seeing that nothing changes."""
    from flowframe.llm import graph

    written = []
    kept = graph.saved
    monkeypatch.setattr(graph, "saved", lambda df, label: written.append(label) or kept(df, label))
    links = spark.createDataFrame([(1, 5), (7, 1), (2, 3), (4, 4)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(1, 1), (5, 1), (7, 1), (2, 2), (3, 2), (4, 4)}
    assert len(written) == 1
    written.clear()
    path = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert {r["component"] for r in components(path).collect()} == {0}
    assert len(written) > 1


def test_filters_are_joined_without_a_shuffle(spark, monkeypatch):
    import numpy as np
    from pyspark import RDD

    from flowframe.llm import ngrams

    monkeypatch.setattr(RDD, "partitionBy", lambda *a, **k: pytest.fail("arrays pass a shuffle"))
    numbers = spark.range(0, 300, 1, 30)
    found = ngrams.hashed_filter(numbers, "id", 12)
    assert ngrams._in_filter(np.arange(300), found, 12).all()
    want = np.zeros(1 << 12, dtype=bool)
    want[ngrams._filter_at(np.arange(300), 12)] = True
    assert (found == np.packbits(want)).all()
    assert not ngrams.hashed_filter(numbers.where("id < 0"), "id", 12).any()
