"""A quality score: kernel ridge regression by random features, then isotonic calibration.

Random Fourier features of the standardised document statistics approximate a Gaussian kernel.
Ridge weights solve normal equations that tasks sum over their rows. Raw scores become
probabilities by isotonic regression on labelled rows that the weights were not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import fold, least_hashed, saved, sum_arrays
from flowframe.llm.stats import NAMES, document_stats

FEATURES = 192
SPREAD = 3.0
PENALTY = 1e-3
#: Labelled rows that the model is fitted on: those with the smallest hashed ids.
MAX_LABELLED = 200_000
#: Raw scores are counted in this many bins for the calibration.
BINS = 2048
ACCEPT = 0.7


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return features(stats, self.mean, self.scale, self.directions, self.phases) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def features(stats: np.ndarray, mean, scale, directions, phases) -> np.ndarray:
    z = np.clip((stats - mean) / scale, -6, 6)
    cosines = np.sqrt(2.0 / len(phases)) * np.cos(z @ directions + phases)
    return np.hstack((np.ones((len(stats), 1)), cosines))


def _stacked(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the non-decreasing fit of total/weight at ascending x, one pair per block."""
    blocks: list[list[float]] = []
    for xi, w, t in zip(x, weight, total, strict=True):
        blocks.append([xi * w, w, t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], a, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(labelled: DataFrame, calibrate: Column, n_features: int = FEATURES, seed: int = 11) -> Model:
    """A model from stats, label (0 or 1) and doc_id; rows where `calibrate` holds fit the calibration.

    `labelled` is bounded by its caller. Its tasks emit sums only: one row of the normal equations'
    matrix each, then counts and label sums per score bin.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    directions = rng.normal(size=(len(NAMES), n_features)) / SPREAD
    phases = rng.uniform(0, 2 * np.pi, n_features)
    none = np.empty(0)
    rows = labelled.select("stats", F.col("label").cast("double").alias("label"), calibrate.alias("held"))

    def one(key: int, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([v.tobytes()], pa.binary())], names=["k", "v"])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _stacked(b, 0)
            yield one(0, np.concatenate(([len(s)], s.sum(0), (s * s).sum(0))))

    schema, k = "k long, v binary", len(NAMES)
    m = sum_arrays(rows.mapInArrow(moments, schema), "k", "v").get(0)
    if m is None:
        return Model(np.zeros(k), np.ones(k), directions, phases, np.zeros(n_features + 1), none, none)
    mean = m[1 : k + 1] / m[0]
    scale = np.sqrt(np.maximum(m[k + 1 :] / m[0] - mean**2, 0))
    scale[scale < 1e-6] = 1.0

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            use = ~b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            y = b.column(1).to_numpy()[use]
            x = np.column_stack((features(_stacked(b, 0)[use], mean, scale, directions, phases), y))
            yield one(0, (x.T @ x).ravel())

    n = n_features + 2
    both = sum_arrays(rows.mapInArrow(normal, schema), "k", "v")[0].reshape(n, n)
    a = both[:-1, :-1] + PENALTY * max(both[0, 0], 1.0) * np.diag([0.0, *[1.0] * n_features])
    weights = np.linalg.lstsq(a, both[:-1, -1], rcond=None)[0]
    model = Model(mean, scale, directions, phases, weights, none, none)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            use = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            y, raw = b.column(1).to_numpy()[use], model.raw(_stacked(b, 0)[use])
            at = np.clip(((raw + 1) / 3 * BINS).astype(int), 0, BINS - 1)  # raw scores lie around 0 to 1
            yield one(0, np.concatenate([np.bincount(at, w, BINS) for w in (np.ones(len(y)), raw, y)]))

    w, x, t = sum_arrays(rows.mapInArrow(counted, schema), "k", "v")[0].reshape(3, BINS)
    full = w > 0
    if full.any():
        model.knots, model.levels = isotonic(x[full] / w[full], w[full], t[full])
    return model


def learn(stats: DataFrame, labels: DataFrame, train: Column, label: str, limit: int = MAX_LABELLED) -> Model:
    """A model from labels of rows where `train` holds, at most `limit` of them by hashed id.

    Null labels and ids teach nothing; repeated rows count as often as they occur. A quarter of
    the labelled rows, by hashed id, is kept for the calibration.
    """
    usable = labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        "doc_id", F.col(label).alias("label")
    )
    sample = least_hashed(usable, "doc_id", limit, "label")
    rows = stats.join(sample, "doc_id").repartition(16, "doc_id").sortWithinPartitions("doc_id")
    rows = saved(rows, "labelled")
    return fit(rows, F.pmod(F.xxhash64(F.lit("calibrate"), F.col("doc_id")), F.lit(4)) == 0)


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of the statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_stacked(b, 1)))], names=["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`.

    Labels of the held-out fold are never read. Empty and null texts are scored like a text
    without words; without any labels every score is 0.5. The statistics, a few numbers for each
    text, are the only thing written; texts are read once and never shuffled.
    """
    stats = saved(document_stats(docs), "stats")
    model = learn(stats, labels, fold(F.col("doc_id"), folds) != held, "quality")
    return scored(stats, model).select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
