"""The pipeline's stages, each held against what its input asks for."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowframe.llm import lines, mixing
from tests.llm.cases import WORD, distance, find_components, gram_set, odd

DATA = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_stages_on_the_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before, stages = by_id(docs), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "line_dedup", "ngram_join", "mixing", "packing"]

    def through(name, df):
        out = stages[name](spark, df, DATA)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    # language: rows are kept or go as they are; these documents are all in a learned language
    spoken = through("language", docs)
    assert spoken.columns == COLUMNS
    after = by_id(spoken)
    assert all(tuple(after[i]) == tuple(before[i]) for i in after)
    assert all(not any(c.isalpha() for c in before[i]["text"] or "") or len(before[i]["text"]) < 12 for i in set(before) - set(after))

    # lines: no line that stays is equal to an earlier one, or within two edits of it
    clean = through("line_dedup", spoken)
    assert clean.columns == COLUMNS
    kept, seen = by_id(clean), {}
    for i in sorted(kept):
        for x in kept[i]["text"].split("\n"):
            if len(x) >= lines.MIN_CHARS and WORD.search(x):
                assert x not in seen
                seen[x] = i
    long = sorted(seen, key=lambda x: (len(x), x))
    for a, b in zip(long, long[1:]):
        assert abs(len(a) - len(b)) > 2 or (a[:6] != b[:6] and a[-6:] != b[-6:]) or distance(a, b) > 2
    first_lines = {}
    for i in sorted(after):
        for x in after[i]["text"].split("\n"):
            first_lines.setdefault(x, i)
    for i in set(after) - set(kept):
        assert all(first_lines[x] < i or len(x) < lines.MIN_CHARS or not WORD.search(x) or near_earlier(x, i, first_lines) for x in after[i]["text"].split("\n"))

    # near duplicates: the smallest id of each component
    single = through("ngram_join", clean)
    assert single.columns == COLUMNS
    sets = {i: gram_set(r["text"], 5) for i, r in kept.items()}
    posts = {}
    for i, s in sets.items():
        for g in s:
            posts.setdefault(g, []).append(i)
    links = {(p[0], i) for p in posts.values() for i in p[1:]}
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert set(by_id(single)) == set(find_components(sets, links).values())

    # mixing: as many copies as planned, each a document as it was
    mixed = through("mixing", single)
    assert mixed.columns == COLUMNS
    planned = {r["doc_id"]: r["_copies"] for r in mixing.mix_plan(single).collect()}
    counts = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert {i: n for i, n in planned.items() if n} == counts

    # packing: every copy is in the sequences once, without a gap
    pieces = through("packing", mixed).collect()
    assert sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)
    ends = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends.get(p["sequence_id"], 0)
        ends[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n == 2048 for s, n in ends.items() if s != max(ends))
    assert {p["doc_id"] for p in pieces} == set(counts)


def test_texts_in_no_learned_language_go(spark, tmp_path):
    """Scripts and languages that no profile has, and letters at random, against texts of two languages."""
    r = random.Random(4)
    english = "the and of to in that it was for on are with as his they be at one have this from or had by hot but some what there we can out other were all your when up use word how said an each she which do their time if will way about many then them would write like so these her long make thing see him two has look more day could go come did my sound no most number who over know water than call first people may down side been now find".split()
    german = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei hatte kann gegen vom können schon wenn habe seine ihre dann unter wir soll ich eines jahr zwei jahren diese dieser wieder keine uhr seiner worden will zwischen immer millionen was sagte".split()
    say = lambda words, n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, say(german if i % 3 else english, r.randint(60, 90)), "de" if i % 3 else "en") for i in range(900)]
    scripts = [(0x430, 0x44F), (0x3B1, 0x3C9), (0xE01, 0xE2E), (0x4E00, 0x5E00), (97, 122)]
    word = lambda a, b: "".join(chr(r.randint(a, b)) for _ in range(r.randint(2, 9)))
    foreign = [" ".join(word(*s) for _ in range(200)) for s in scripts for _ in range(20)]
    foreign += [
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ahi quanto a dir qual era e cosa dura questa selva selvaggia e aspra e forte che nel pensier rinova la paura",
        "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Dziś piękność twą w całej ozdobie widzę i opisuję, bo tęsknię po tobie. Panno święta, co jasnej bronisz Częstochowy",
    ]
    rows += [(1000 + i, text, None) for i, text in enumerate(foreign)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"] for x in dict(corpus_pipeline.STAGES)["language"](spark, docs, str(tmp_path)).collect()}
    assert got == set(range(900))


def test_near_duplicates_by_five_words_and_four_fifths(spark, tmp_path):
    """A copy with 22% of text appended goes, one with 30% stays; the similarity is of five-word sets."""
    words = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate([words[:104], words[:126], words[200:304], words[200:334]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = [gram_set(r[1], 5) for r in rows]
    assert [round(len(a & b) / len(a | b), 2) for a, b in ((sets[0], sets[1]), (sets[2], sets[3]))] == [0.82, 0.77]
    assert sorted(by_id(dict(corpus_pipeline.STAGES)["ngram_join"](spark, docs, str(tmp_path)))) == [0, 2, 3]


def near_earlier(line, i, first):
    return any(j < i and abs(len(x) - len(line)) <= 2 and distance(x, line) <= 2 for x, j in first.items())


def test_odd_rows_pass_every_stage(spark, tmp_path):
    docs = odd(spark, [(100 + i, f"these are some English words of text number {i} and more of them") for i in range(30)])
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        out = stage(spark, docs, str(tmp_path))
        assert n == 4 or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0


def test_empty_tables_pass_every_stage(spark, tmp_path):
    docs = odd(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


CLASHING = "lang_pred score n_grams _size _copies _copy _source _rate _seed _target _source_size _doc _t _rest _gone _n _first _row _node _key _id c0 c1 given key h n".split()


def test_columns_of_any_name_come_through(spark, tmp_path):
    """Extra columns named like an operator's own keep their values in every stage but the last."""
    rows = [(i, f"these are some English words of text number {i} and more of them, all different: " + " ".join(f"w{i * j}x" for j in range(30)), "en", "s" if i % 3 else "t", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select(*[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING[:9]], *docs.columns, *[(F.col("doc_id") * 100 + i).alias(c) for i, c in enumerate(CLASHING[9:])])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        assert got.columns == docs.columns and got.count() > 0
        for r in got.collect():
            assert all(r[c] == f"{c}-{r['doc_id']}" for c in CLASHING[:9])
            assert all(r[c] == r["doc_id"] * 100 + i for i, c in enumerate(CLASHING[9:]))
        docs = got


def test_near_duplicates_without_and_with_shared_ids(spark, tmp_path):
    """Texts without an id are compared as well, and a text that shares its id with another is not lost."""
    say = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    rows = [(1, say(1)), (1, say(2)), (None, say(3)), (None, say(3)), (None, say(4)), (2, say(4) + " more"), (3, say(5)), (3, say(5)), (4, None), (5, ""), (None, say(6))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:7]) for r in dict(corpus_pipeline.STAGES)["ngram_join"](spark, docs, str(tmp_path)).collect())
    assert got == [(0, "word3x0"), (0, "word6x0"), (1, "word1x0"), (1, "word2x0"), (2, "word4x0"), (3, "word5x0"), (4, ""), (5, "")]


def test_mixing_without_ids_comes_near_its_target(spark):
    rows = [(None, " ".join(f"w{i}" for _ in range(5 + i % 9)), "en", "ab"[i % 2], 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in mixing.mix_report(docs).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) < 0.03 * r["target"]
