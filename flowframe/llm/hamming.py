"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: signs after learned rotations. Codes are split into substrings, and
each substring is indexed. If a code lies within Hamming radius r of the query's, one of its m
substrings lies within r // m (pigeonhole), so probing each index with all substring values in
that small radius retrieves every code within r. What is retrieved is ranked by the original
vectors.

Nearness is the inner product, to which a vector's length belongs but which its code forgets. So
the rows of a block are indexed in bands of like length. A distance of codes gives an angle, and with
the band's greatest length a bound for the product: the longer the vectors of a band, the farther
it is searched.

The index is partitioned by rows: each task holds the substring tables of one block and answers
all queries for it, in blocks of queries. A row is in one block, so large groups of equal vectors
spread over all of them, and a query's answers from all blocks are merged by rank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import least_hashed, saved

#: Vectors that the rotations are learned from: those with the smallest hashed ids.
MAX_SAMPLE = 4096
ROTATIONS = 2
ROUNDS = 12
#: The radius of a query in a block is the smallest that holds this many codes, or this share.
LEAST_CODES = 512
SHARE = 0.15
BLOCK_ROWS = 8192
QUERY_ROWS = 8192
#: Bands of like length in a block, at most; a band's lengths differ by a tenth at least.
BANDS = 16
NEAREST = 20
_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_BYTES = np.arange(256, dtype=np.uint8)


@dataclass
class Codes:
    """Rotations learned from a sample: for each, a mean and a square matrix."""

    mean: np.ndarray
    rotations: np.ndarray

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Packed codes, one row of bytes for each vector."""
        centred = x - self.mean
        return np.packbits(np.hstack([centred @ r > 0 for r in self.rotations]), axis=1)


def learn_codes(sample: np.ndarray, rotations: int = ROTATIONS, rounds: int = ROUNDS, seed: int = 5) -> Codes:
    """Iterative quantisation: each rotation is turned until the signs fit the rotated sample best."""
    rng = np.random.Generator(np.random.PCG64(seed))
    d = sample.shape[1]
    mean = sample.mean(0) if len(sample) else np.zeros(d)
    x = sample - mean
    found = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds if len(sample) else 0):
            u, _, v = np.linalg.svd(np.sign(x @ r).T @ x)
            r = (u @ v).T
        found.append(r)
    return Codes(mean, np.array(found))


class Block:
    """The substring indexes of some rows: for each byte of the code, the rows ordered by it."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.first = [np.concatenate(([0], np.cumsum(np.bincount(c, minlength=256)))) for c in codes.T]

    def bucket_rows(self, j: int, values: np.ndarray) -> np.ndarray:
        """The rows in the buckets of some values of substring j."""
        start, end = self.first[j][values], self.first[j][values + 1]
        n = end - start
        return self.order[j][np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """The rows whose code lies within the radius: probing, then one check of the whole code.

        With radius = m * a + b, a code in range has a substring among the first b + 1 within a,
        or one of the others within a - 1.
        """
        a, b = divmod(radius, len(query))
        seen = np.zeros(len(self.codes), dtype=bool)
        for j, value in enumerate(query):
            near = np.flatnonzero(_POP[_BYTES ^ value] <= (a if j <= b else a - 1))
            seen[self.bucket_rows(j, near)] = True
        rows = np.flatnonzero(seen)
        return rows[_distances(self.codes[rows], query) <= radius]

    def sample(self, query: np.ndarray, step: int) -> np.ndarray:
        """The distances of evenly spaced rows."""
        return _distances(self.codes[::step], query)


def bands(lengths: np.ndarray, most: int = BANDS) -> list[np.ndarray]:
    """The rows in groups of like length, the longest first."""
    if not len(lengths):
        return []
    order = np.argsort(-lengths, kind="stable")
    step = max(0.1, np.log(lengths[order[0]] / lengths[order[-1]]) / most)
    level = np.minimum((np.log(lengths[order[0]] / lengths[order]) / step).astype(int), most - 1)
    return [order[level == k] for k in np.unique(level)]


def radii(blocks: list[Block], longest: list[float], query: np.ndarray, wanted: int) -> list[int]:
    """A radius for each band, so that together they hold about `wanted` codes.

    A distance of h of m bits stands for an angle of pi * h / m. The products that these angles and
    the bands' lengths promise are estimated on evenly spaced rows; the radius of a band is the largest
    whose product is among the best `wanted`.
    """
    m, total = 8 * len(query), sum(len(b.codes) for b in blocks)
    step = max(1, total // 1024)
    sizes = [b.sample(query, step) for b in blocks]
    promised = np.concatenate([n * np.cos(np.pi * d / m) for n, d in zip(longest, sizes, strict=True)])
    least = np.sort(promised)[::-1][min(len(promised) - 1, max(0, -(-wanted // step) - 1))]
    cos = np.array(longest)
    reach = np.arccos(np.clip(least / cos, -1, 1)) * m / np.pi
    return [int(np.floor(r + 1e-9)) if least <= n else -1 for r, n in zip(reach, cos, strict=True)]


def _distances(codes: np.ndarray, query: np.ndarray) -> np.ndarray:
    return _POP[codes ^ query].sum(axis=1, dtype=np.int64)


def search_block(
    codes: Codes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, nearest: int = NEAREST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's best in the block, ties to smaller ids; never itself.

    Scores are sums of products in double precision, always in the same order, so equal vectors
    score alike wherever they are.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    found, coded = [], codes.encode(vectors)
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    groups = bands(lengths)
    blocks, longest = [Block(coded[g]) for g in groups], [float(lengths[g].max()) for g in groups]
    wanted = max(LEAST_CODES, int(SHARE * len(ids)))
    for qid, q, code in zip(query_ids, queries, codes.encode(queries), strict=True):
        reach = radii(blocks, longest, code, wanted) if blocks else []
        rows = [g[b.within(code, r)] for g, b, r in zip(groups, blocks, reach, strict=True) if r >= 0]
        rows = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
        rows = rows[ids[rows] != qid]
        rough = vectors[rows] @ q
        if len(rows) > nearest:
            least = np.partition(rough, len(rough) - nearest)[len(rough) - nearest]
            rows = rows[rough >= least - 1e-6 * max(1.0, abs(least))]
        scores = (vectors[rows] * q).sum(axis=1)
        top = np.lexsort((ids[rows], -scores))[:nearest]
        found.append((np.full(len(top), qid), ids[rows][top], scores[top]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (doubles) of the rows that take part, one row per id.

    Left out are null ids, null and zero vectors, those with a null or non-finite component, and
    those of another length than most. Of several rows of one id the smallest vector is taken.
    """
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") > 0) & fine & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == (sizes["d"] if sizes else 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1)


def nearest_by_inner_product(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    is_query,
    nearest: int = NEAREST,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where `is_query` (of column id) holds, its nearest rows.

    Every row is a candidate, but the query's own. Rows and queries are dealt into blocks by
    hashed id; a group is one block of rows with one block of queries, so its size is bounded
    whatever the data, and copies of one vector are spread. A group returns `nearest` rows for
    each query at most, and their best are the result. An empty table gives no rows.
    """
    rows = saved(usable_vectors(df, id_col, vector_col), "vectors")
    sample = least_hashed(rows, "id", MAX_SAMPLE).toArrow()
    d = len(sample.column("v")[0]) if len(sample) else 1
    codes = learn_codes(_matrix(sample.column("v"), len(sample)) if len(sample) else np.empty((0, d)))
    n, n_queries = rows.count(), rows.where(is_query).count()
    blocks, query_blocks = -(-n // block_rows) or 1, -(-n_queries // query_rows) or 1
    deal = lambda seed, k: F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(k)).cast("int")
    index = rows.select("id", "v", deal("rows", blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"))
    asked = rows.where(is_query).select(
        "id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), deal("queries", query_blocks).alias("part")
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            empty = np.empty(0, np.int64)
            got = (empty, empty, np.empty(0))
        else:
            got = search_block(
                codes,
                left.column("id").to_numpy(),
                _matrix(left.column("v"), len(left)),
                right.column("id").to_numpy(),
                _matrix(right.column("v"), len(right)),
                nearest,
            )
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()), "score": pa.array(got[2], pa.float64())})

    found = index.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        run, "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
