"""Mixing sources to target weights by repeating documents.

Words are counted per source, every source gets a target, and each document is emitted
floor(rate) times plus one more copy with the fraction as its probability. The draw is a hash
of the document's id and a seed, so every run and every retried task decides the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import n_words, named_back, numbered

#: Weights of the sources in code point order, nulls last, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_RATE = 3.0
SEEDS = 16


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per source: source, source_size, target, rate.

    `sizes` has source and size. All targets together are the total size. No target exceeds
    `max_rate` times its source's size; what is cut off goes to the others by weight until none
    is above. The end of that resharing is found at once: sources are sorted by the share at
    which they hit their limit, and the common share is that of the first place where the rest
    stays below, which is the highest of all such shares. A source of no words has target and rate 0. This orders sources, not documents:
    one row per source, which a window over the whole frame can hold.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    weighed = totals.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(max_rate)).withColumn(
        "full_at", F.col("most") / F.col("weight")
    )
    # levels: the share per weight if this source and all that fill up later are below their limits
    later = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    levels = weighed.withColumn("total", F.sum("source_size").over(every)).withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(later),
    )
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every)
    # where even the last source is full, all are
    target = F.least(F.col("most"), F.coalesce(F.col("weight") * level, F.col("most")))
    return levels.select(
        "source",
        "source_size",
        target.cast("double").alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def drawn_by() -> Column:
    """What a row draws by: its id; without one, its text, so that rows without an id draw apart."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))


def draw(key: Column, seed: Column) -> Column:
    """A number in [0, 1) from a row's key and the seed."""
    digest = F.md5(F.concat(key, F.lit(":"), seed.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_plan(
    docs: DataFrame, weights: tuple = WEIGHTS, max_rate: float = MAX_RATE, seeds: int = SEEDS
) -> DataFrame:
    """All rows of `docs` with _size, _source_size, _target and _copies.

    Among `seeds` seeds each source uses the one whose draws bring its taken words nearest to its
    target (ties: the smallest seed). They are judged in one aggregation that combines before
    its shuffle, so a source that holds a third of all rows costs no more than any other.

    A null text counts 0 words, null sources are a source of their own, rows without an id draw by
    their texts, repeated rows draw alike. Empty tables give empty results. Other columns pass
    through, whatever their names (but for the four that are added).
    """
    # sizes and draws need the text; behind this, texts pass no shuffle that doesn't ask for them
    sized = docs.withColumn("_size", n_words(F.col("text"))).withColumn("_drawn", drawn_by())
    small = sized.select("source", F.col("_size").alias("size"))
    targets = source_targets(small, weights, max_rate)
    keyed = sized.select(F.col("_drawn").alias("key"), F.col("source"), F.col("_size").alias("size"))
    whole, part = F.floor("rate"), F.col("rate") - F.floor("rate")
    off = [
        F.sum(F.when(draw(F.col("key"), F.lit(s)) < part, F.col("size")).otherwise(F.lit(0))).alias(f"extra{s}")
        for s in range(seeds)
    ]
    joined = keyed.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    sums = joined.groupBy("_source").agg(
        F.first("source_size").alias("_source_size"), F.first("target").alias("_target"), F.first("rate").alias("_rate"), *off
    )
    gaps = F.array(
        *[
            F.struct(
                F.abs(F.floor("_rate") * F.col("_source_size") + F.col(f"extra{s}") - F.col("_target")).alias("gap"),
                F.lit(s).alias("seed"),
            )
            for s in range(seeds)
        ]
    )
    chosen = sums.select(
        "_source", "_source_size", "_target", "_rate", F.array_min(gaps)["seed"].alias("_seed")
    )
    out = sized.join(chosen, sized["source"].eqNullSafe(chosen["_source"]))
    u = draw(F.col("_drawn"), F.col("_seed"))
    whole, part = F.floor("_rate"), F.col("_rate") - F.floor("_rate")
    copies = whole + F.when(u < part, 1).otherwise(0)
    return out.withColumn("_copies", copies.cast("long")).drop("_source", "_rate", "_seed", "_drawn")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_rate: float = MAX_RATE, seeds: int = SEEDS) -> DataFrame:
    """The mixed corpus: each row as many times as its plan says, with the columns of `docs`."""
    used = ("doc_id", "source", "text")
    planned = mix_plan(numbered(docs, *used), weights, max_rate, seeds).where(F.col("_copies") > 0)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))
    return named_back(planned.withColumn("_copy", copies), docs, *used)


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    slim = docs.select("doc_id", "source", "text")
    return mix_plan(slim).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


#: The report as SQL over `documents`.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, ''))) AS key, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, source_size * 3.0::DOUBLE AS most, source_size * 3.0::DOUBLE / weight AS full_at,
         ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(source_size * 3.0::DOUBLE) OVER (
             ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals
), targets AS (
  SELECT source, source_size,
         least(most, coalesce(weight * max(CASE WHEN level <= full_at THEN level END) OVER (), most)) AS target
  FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
), draws AS (
  SELECT d.doc_id, d.size, r.source, r.source_size, r.target, r.rate, s.seed,
         floor(r.rate) + CASE WHEN ('0x' || substr(md5(d.key || ':' || s.seed), 1, 8))::UBIGINT
                                    / 4294967296.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source, range(16) s(seed)
), chosen AS (
  SELECT source, min_by(seed, (gap, seed)) AS seed
  FROM (SELECT source, seed, abs(sum(copies * size) - any_value(target)) AS gap FROM draws GROUP BY source, seed) GROUP BY source
)
SELECT d.doc_id, d.size, d.source_size, d.target, (d.size * d.copies)::BIGINT AS taken
FROM draws d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.seed = c.seed
"""
