"""The inverted multi-index against all pairs."""

import math
import random

import numpy as np
import pytest

from flowframe.llm import multiindex
from tests.llm.cases import find_components

SCHEMA = "vec_id long, embedding array<float>, label int, h1 int, kept string"


def brute_force(rows):
    """vec_id -> (n_links, component_id, kept) for one usable row an id."""
    best, ids = {}, []
    size = 0
    for i, v, label, *_ in rows:
        if i is None:
            continue
        ids.append(i)
        fine = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if fine:
            v = [float(np.float32(x)) for x in v]
            size = size or len(v)
            if len(v) == size:
                best[i] = min(best.get(i, (label, v)), (label, v))
    names = sorted(best)
    m = np.array([best[i][1] for i in names])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    label = np.array([best[i][0] for i in names])
    near = (m @ m.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    links = [(names[a], names[b]) for a, b in zip(*np.nonzero(near))]
    comp = find_components(set(ids), links)
    n = dict(zip(names, near.sum(axis=1)))
    return {i: (int(n.get(i, 0)), comp[i], comp[i] == i) for i in ids}


def vectors(seed, n, groups, d=16):
    """Groups of near copies of every tightness, some with scaled and equal vectors."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        g = r.integers(groups) if r.random() < 0.6 else None
        centre = np.random.default_rng(1000 + g).normal(size=d) if g is not None else r.normal(size=d)
        noise = r.normal(size=d) * (0.02 + 0.08 * (g or 0)) if g is not None else 0
        v = (centre + noise) * r.choice([1.0, 0.01, 300.0])
        rows.append((i + 10, [float(x) for x in v], int(g % 2 if g is not None else r.integers(3)), 7, "x"))
    rows += [(2000 + i, rows[i % 9][1], rows[i % 9][2], 7, "x") for i in range(40)]
    return rows


ODD = [
    (1, None, 1, 7, "x"),
    (2, [], 1, 7, "x"),
    (3, [0.0] * 16, 1, 7, "x"),
    (4, [1.0] * 15 + [None], 1, 7, "x"),
    (5, [1.0] * 15 + [float("nan")], 1, 7, "x"),
    (6, [1.0] * 15 + [float("inf")], 1, 7, "x"),
    (7, [1.0] * 16, None, 7, "x"),
    (8, [1.0, 2.0], 1, 7, "x"),
    (9, [1.0] * 16, 1, 7, "x"),
    (9, [1.0] * 16, 1, 7, "x"),
    (3000, [-0.0] * 4 + [1.0] * 12, 2, 7, "x"),
    (3001, [0.0] * 4 + [2.0] * 12, 2, 7, "x"),
    (3002, [1e30] * 16, 1, 7, "x"),
]


@pytest.mark.parametrize("seed, cell_rows, ball_from, block_rows", [(1, 8, 10, 16), (2, 64, 256, 2048), (3, 4, 20, 7)])
def test_all_links_are_found(spark, seed, cell_rows, ball_from, block_rows):
    rows = vectors(seed, 500, 6) + ODD
    df = spark.createDataFrame(rows + [(None, [1.0] * 16, 1, 7, "x")], SCHEMA)
    got = multiindex.near_vectors(df, cell_rows=cell_rows, ball_from=ball_from, block_rows=block_rows).collect()
    want = brute_force(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None} == want
    assert len(got) == len(want) + 1
    assert [tuple(r) for r in got if r["vec_id"] is None] == [(None, 0, None, True)]
    assert max(n for n, _, _ in want.values()) > 30


def test_empty_and_unusable_tables(spark):
    df = spark.createDataFrame(ODD[:3], SCHEMA)
    assert multiindex.near_vectors(df.limit(0)).count() == 0
    assert sorted(map(tuple, multiindex.near_vectors(df).collect())) == [(i, 0, i, True) for i in (1, 2, 3)]
    one = spark.createDataFrame([(1, [2.0], 1, 7, "x"), (2, [3.0], 1, 7, "x"), (3, [-1.0], 1, 7, "x")], SCHEMA)
    assert sorted(map(tuple, multiindex.near_vectors(one).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_multi_sequence_is_in_order():
    r = random.Random(2)
    a, b = sorted(r.random() for _ in range(30)), sorted(r.random() for _ in range(20))
    got = list(multiindex.multi_sequence(np.array(a), np.array(b), 0.9))
    sums = [a[i] + b[j] for i, j in got]
    assert sums == sorted(sums) and set(got) == {(i, j) for i in range(30) for j in range(20) if a[i] + b[j] <= 0.9}


def test_large_groups_are_not_multiplied_out(spark):
    """A group of near copies is one ball: no entries of it are left to be compared by pairs."""
    r = np.random.default_rng(5)
    centre = r.normal(size=32)
    rows = [(i, [float(x) for x in centre + 0.05 * r.normal(size=32)], 1) for i in range(3000)]
    rows += [(10_000 + i, [float(x) for x in r.normal(size=32)], 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x["vec_id"]: x for x in multiindex.near_vectors(df, cell_rows=400).collect()}
    assert all(got[i]["n_links"] == 2999 and got[i]["component_id"] == 0 for i in range(3000))
    assert all(got[i]["n_links"] == 0 for i in range(10_000, 11_000))
    unit = multiindex._unit(np.array([v for _, v, _ in rows[:512]]))
    found = multiindex.centres(unit, math.acos(0.93) / 2 - 1e-7)
    assert len(found) == 1 and (unit @ found[0] >= math.cos(math.acos(0.93) / 2 - 1e-7)).all()
