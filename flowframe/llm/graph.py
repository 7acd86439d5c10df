"""Connected components as joins, for links that never come to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import saved


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with m, the least of u and all its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _stars(e: DataFrame) -> bool:
    """Whether distinct links of u to a lesser v are stars: each u has one v, and no v is a u."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(e.select("v", F.lit(0)))
    told = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return told.agg(F.count_if(F.expr("ups > 1 OR ups = 1 AND low = 0"))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node and component, the least node that links reach, for every node of columns a and b.

    Large-star and small-star steps alternate until the links are stars, each result written to
    the shared folder. Pairs shrink to one per node, and the number of rounds grows with the
    logarithm of the longest path. Links of a node to itself keep it as its own component.
    """
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    own = known.select(F.col("a").alias("node")).union(known.select("b")).distinct()
    e = known.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = saved(e, "links")
    while not _stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _to_least(large)
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.where("u != m").select("u", F.col("m").alias("v"))
        )
        e = saved(small.distinct(), "links")
    return own.join(e.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
