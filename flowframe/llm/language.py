"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vectors of a letter n-gram are permuted by
their place and bound by multiplication; a text is the sum of its n-gram vectors. A language is
the sum of its texts' unit vectors, and a text goes to the language with the largest cosine.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from flowframe.llm.common import bound_batches, hash_share, named_back, numbered, saved, sum_arrays, texts

DIM = 1024
GRAM = 3
#: n-gram vectors that a worker keeps.
KEPT = 16_000
UNKNOWN = "und"
#: Standard deviations of the noise, 1 / sqrt(dim), that a cosine must reach for a text to be in a known language.
NOISE = 4
#: A low quantile of labelled texts' cosines, by number of different n-grams: a text must come as
#: far as halfway from the noise to it. And the least number of texts that a quantile is taken from.
QUANTILE, LEAST_TEXTS = 0.01, 50
#: Parts of the cosines' range that are counted to find where a quantile lies.
PARTS = 4096


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: its number if it is a letter, else 0 (a gap between words)."""
    out = np.zeros(0x110000, dtype=np.int64)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            out[c] = c
    return out


class Space:
    """The letter vectors and the n-gram vectors made of them, for one dimension and seed."""

    def __init__(self, dim: int, gram: int, seed: int = 7):
        self.dim, self.gram, self.seed = dim, gram, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, dim), dtype=np.int8)

    def letter(self, code: int) -> np.ndarray:
        v = self.letters.get(code)
        if v is None:
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dim, dtype=np.int8)
            v = self.letters[code] = bits * 2 - 1
        return v

    def gram_vector(self, key: int) -> np.ndarray:
        out = np.ones(self.dim, dtype=np.int8)
        for place in range(self.gram):
            out *= np.roll(self.letter(key & 0x1FFFFF), place)
            key >>= 21
        return out

    def vector(self, text: str) -> np.ndarray | None:
        """The sum of the text's n-gram vectors; None for a text without letters."""
        return self.counted(text)[0]

    def counted(self, text: str) -> tuple[np.ndarray | None, int]:
        """The text's vector and the number of its different n-grams."""
        codes = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        if not codes.any():
            return None, 0
        codes = np.concatenate(([0], codes, [0]))
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)  # one gap between words
        codes = codes[keep]
        n = len(codes) - self.gram + 1
        keys = np.zeros(n, dtype=np.int64)
        for place in range(self.gram):
            keys = keys << 21 | codes[place : place + n]
        found, counts = np.unique(keys, return_counts=True)
        if len(self.rows) + len(found) > KEPT:
            self.rows.clear()
        total = np.zeros(self.dim)
        for i in range(0, len(found), 8192):  # a text of many different n-grams stays small in memory
            part = found[i : i + 8192].tolist()
            at = np.fromiter((self.row(k) for k in part), dtype=np.int64, count=len(part))
            total += counts[i : i + 8192].astype(np.float32) @ self.table[at].astype(np.float32)
        return total, len(found)

    def row(self, key: int) -> int:
        at = self.rows.get(key)
        if at is None:
            at = self.rows[key] = len(self.rows)
            if at >= len(self.table):
                self.table = np.concatenate((self.table, np.empty_like(self.table)))
            self.table[at] = self.gram_vector(key)
        return at


@lru_cache(maxsize=2)
def space(dim: int, gram: int) -> Space:
    return Space(dim, gram)


def _labelled(docs: DataFrame, rows: Column, per_language: int | None = None) -> DataFrame:
    """doc_id, lang and text of all labelled rows, or of at most `per_language` of each language, those
    with the smallest hashed ids."""
    usable = rows & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    if per_language is None:
        return docs.where(usable).select("doc_id", "lang", "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    labelled = docs.where(usable).select("doc_id", "lang")
    # languages are counted first: rows whose hash is twice as large as need be go in the scan
    counts = labelled.groupBy("lang").agg((F.lit(2.0 * per_language) / F.count(F.lit(1))).alias("_share"))
    few = labelled.join(counts, "lang").where(hash_share(F.col("doc_id"), F.col("_share")))
    chosen = few.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
    # at most per_language ids for each language: small by that bound
    return docs.where(usable).select("doc_id", "lang", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")


def learn_profiles(
    docs: DataFrame, train: Column, per_language: int | None = None, dim: int = DIM, gram: int = GRAM
) -> dict[str, np.ndarray]:
    """Unit vectors by language from the texts of rows where `train` holds and lang isn't null.

    Each task sums its texts, so no text is moved. `per_language` bounds the texts of each language
    for callers that want a sample: the choice is by hashed id, made on narrow rows.
    """
    bound_batches(docs.sparkSession)
    sample = _labelled(docs, train, per_language)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, sums = space(dim, gram), {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = s.vector(text or "")
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + v / max(np.linalg.norm(v), 1e-12)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([np.asarray(v, dtype=np.float64).tobytes() for v in sums.values()], pa.binary())],
                names=["lang", "profile"],
            )

    rows = sample.select("lang", "text").mapInArrow(bundle, "lang string, profile binary")
    profiles = sum_arrays(rows, "lang", "profile")
    return {k: v / max(np.linalg.norm(v), 1e-12) for k, v in sorted(profiles.items())}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], dim: int = DIM, gram: int = GRAM) -> DataFrame:
    """`docs` with lang_pred and score, the largest cosine (0 at least).

    Null, empty and letterless texts are `und` with score 0, and so is every text where no
    profile was learned. Equal cosines go to the language that sorts first.
    """
    return _identified(docs, profiles, dim, gram).drop("n_grams")


def _identified(docs: DataFrame, profiles: dict[str, np.ndarray], dim: int = DIM, gram: int = GRAM) -> DataFrame:
    """The rows of identify, with n_grams: how many different n-grams the text has."""
    bound_batches(docs.sparkSession)
    names = list(profiles)
    matrix = np.array([profiles[n] for n in names], dtype=np.float64).reshape(len(names), dim)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "n_grams")]
    at = kept.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space(dim, gram)
        for batch in batches:
            langs, scores, sizes = [], [], []
            for text in texts(batch.column(at)):
                v, n = s.counted(text) if names else (None, 0)
                sizes.append(n)
                if v is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cos = matrix @ v / max(np.linalg.norm(v), 1e-12)
                best = int(np.argmax(cos))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, cos[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())],
                names=[*kept, "lang_pred", "score", "n_grams"],
            )

    out = docs.select(*kept)
    schema = StructType([*out.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("n_grams", LongType())])
    return out.mapInArrow(predict, schema)


def _size(n_grams: Column) -> Column:
    """The size of a text: n of 2^n and more different n-grams."""
    return F.floor(F.log2(F.greatest(n_grams, F.lit(1)))).cast("int")


def learn_least(
    docs: DataFrame, held: Column, profiles: dict[str, np.ndarray], per_language: int | None = None
) -> dict[int, float]:
    """The least cosine by size, from labelled rows that the profiles were not learned from.

    It lies halfway between the noise and a low quantile of the rows that go to their own language.
    A size with too few rows has that of the next smaller one. All such rows are read; `per_language`
    bounds them for callers that want a sample.
    """
    found = _identified(_labelled(docs, held, per_language), profiles).where(F.col("lang") == F.col("lang_pred"))
    scores = saved(found.select(_size(F.col("n_grams")).alias("size"), "score"), "language-scores")
    return {r["size"]: (r["least"] + NOISE / DIM**0.5) / 2 for r in _quantiles(scores).collect()}


def _quantiles(scores: DataFrame) -> DataFrame:
    """size and least, the exact low quantile of its scores, for sizes with enough rows.

    Scores are counted by parts of their range first; only those of the one or two parts in which the
    quantile's neighbours lie are put in order, so no task orders all scores of a size.
    """
    part = F.floor(F.col("score") * PARTS).cast("int")
    counts = scores.groupBy("size", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    by_size = Window.partitionBy("size")
    place = F.lit(QUANTILE) * (F.col("total") - 1)
    placed = (
        counts.withColumn("total", F.sum("n").over(by_size))
        .withColumn("upto", F.sum("n").over(by_size.orderBy("part")))
        .where(F.col("total") >= LEAST_TEXTS)
        .select("size", "part", (F.col("upto") - F.col("n")).alias("before"), "upto", place.alias("place"))
        .where((F.col("before") <= F.ceil("place")) & (F.col("upto") > F.floor("place")))
    )
    order = Window.partitionBy("size", "part").orderBy("score")
    near = scores.withColumn("part", part).join(F.broadcast(placed), ["size", "part"])
    at = near.withColumn("at", F.col("before") + F.row_number().over(order) - 1)
    low, high = (F.max(F.when(F.col("at") == f("place"), F.col("score"))) for f in (F.floor, F.ceil))
    share = F.max(F.col("place") - F.floor("place"))
    return at.groupBy("size").agg((low + (high - low) * share).alias("least"))


def accepted(docs: DataFrame, profiles: dict[str, np.ndarray], least: dict[int, float] | None = None) -> DataFrame:
    """`docs` without the texts that are in no known language: those without letters, those whose
    cosines are all within the noise, and those below the least cosine of their size. Columns stay
    as they are."""
    found = _identified(numbered(docs, "text"), profiles)
    noise = F.lit(NOISE / DIM**0.5)
    bound = noise
    for size, score in sorted((least or {}).items()):
        bound = F.when(_size(F.col("n_grams")) >= size, F.greatest(F.lit(score), noise)).otherwise(bound)
    good = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= bound))
    return named_back(good, docs, "text")
