"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from flowframe.llm import variants
from tests.llm.cases import distance, frame, odd

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_force(rows):
    counts = Counter()
    for r in rows:
        for run in RUN.findall(r["text"] or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if abs(len(x) - len(w)) <= 1 and distance(x, w) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    found = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        found[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return found


def as_dict(df):
    rows = df.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("seed, most_bytes", [(1, variants.MAX_FILTER_BYTES), (2, 64)])
def test_variants(spark, seed, most_bytes):
    """Also with filters so small that they hold back next to nothing."""
    r = random.Random(seed)
    bases = ["".join(r.choice("abcdeéÀß÷") for _ in range(r.randint(5, 9))) for _ in range(12)]
    spelled = []
    for w in bases:
        spelled += [w] * 200
        for _ in range(6):
            out = list(w)
            for _ in range(r.choice([1, 1, 2])):
                at = r.randrange(len(out))
                kind = r.randrange(3)
                out[at : at + (kind > 0)] = [] if kind == 2 else [r.choice("abcdeéÀß÷ÿz")]
            spelled += ["".join(out)] * r.choice([1, 4, 5, 7, 30, 41])
    r.shuffle(spelled)
    rows = [(100 + i, r.choice([" ", ", ", "\n", "1"]).join(x if r.random() < 0.8 else x.title() for x in spelled[i::40]), "en", "s") for i in range(40)]
    rows += [(None, "doubled doubled doubled doubled doubled dubbled " * 3, "en", "s"), (6000, "chaina " * 150 + "chainab " * 30 + "chainabc " * 6, "en", "s"), (7000, "x" * 3000 + " " + ("y" * 2000 + " ") * 6 + ("y" * 1999 + " ") * 31, "en", "s")]
    docs = odd(spark, [*rows, rows[0], rows[0]])
    want = brute_force(docs.collect())
    got = as_dict(variants.spelling_variants(docs, most_bytes))
    assert got == want
    assert sum(f is not None for f, *_ in want.values()) > 10 and any(n > 2 for _, _, _, n, _ in want.values())
    assert want["chainabc"][:2] == ("chainab", "chaina") and want["y" * 2000][0] == "y" * 1999


def test_ties_go_to_the_least_word(spark):
    rows = [(1, "aaaaaa " * 5 + "aaaaab " * 50 + "aaaaaé " * 50 + "Aaaaaac " * 50 + "zaaaaa " * 49, "en", "s")]
    got = as_dict(variants.spelling_variants(frame(spark, rows)))
    assert got == brute_force(frame(spark, rows).collect()) and got["aaaaaa"][0] == "aaaaaac"[:7]


def test_tables_without_words(spark):
    docs = odd(spark)
    assert variants.spelling_variants(docs.limit(0)).count() == 0
    empty = variants.spelling_variants(frame(spark, [(1, "few words here", "en", "s"), (2, None)]))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_long_chains_end_at_one_root(spark):
    links = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("x", "w010")]
    got = dict(map(tuple, variants.roots(spark.createDataFrame(links, "word string, form string")).collect()))
    assert got == {w: "w037" for w, _ in links}
