"""Roll parent pointers up to their root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators.columns import quoted
from flowframe.session import ensure_checkpoint_dir

ORPHAN = "n/a"
CYCLE = "cycle"


def hierarchy_root(
    df: DataFrame, group: Sequence[str], item: str, parent: str, root_marker: str = "000000", out: str = "root"
) -> DataFrame:
    """For each item, the root its parent pointers lead to within its group.

    An item whose parent is `root_marker` is its own root. A pointer to an item that does not
    exist leads to `n/a`, and one that runs into a circle to `cycle`. Every row gets a root: null
    groups are one group, and a row without an item leads to `n/a`.

    Pointers double in every round, so a chain of length d takes log2(d) joins, each keyed by
    (group, item): a large group spreads over all reducers. As long as an open item is on no
    circle, a round closes at least one, so the first round without progress leaves exactly
    the circles. Each round is cut off by a reliable checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [*group, "__item"]
    nodes = df.select(
        *[F.col(quoted(g)) for g in group],
        F.col(quoted(item)).cast("string").alias("__item"),
        F.col(quoted(parent)).cast("string").alias("__next"),
    )
    # a repeated item keeps its greatest parent
    nodes = nodes.groupBy(*keys).agg(F.max("__next").alias("__next"))
    # an item without a pointer leads nowhere
    start = F.when(F.col("__next") == root_marker, F.col("__item")).when(F.col("__next").isNull(), F.lit(ORPHAN))
    state = nodes.withColumn("__root", start).checkpoint()
    open_items = state.filter("__root IS NULL").count()
    while open_items:
        target = state.select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
            F.col("__item").alias("__to"),
            F.col("__next").alias("__jump"),
            F.col("__root").alias("__found"),
        )
        waiting = state.filter("__root IS NULL")
        on = F.col("__next") == F.col("__to")
        for i, g in enumerate(group):
            on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
        moved = waiting.join(target, on, "left").select(
            *keys,
            F.col("__jump").alias("__next"),
            F.when(F.col("__to").isNull(), F.lit(ORPHAN)).otherwise(F.col("__found")).alias("__root"),
        )
        state = state.filter("__root IS NOT NULL").select(*keys, "__next", "__root").unionByName(moved).checkpoint()
        left = state.filter("__root IS NULL").count()
        if left == open_items:
            break
        open_items = left
    roots = state.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col("__item").alias("__to"),
        F.coalesce("__root", F.lit(CYCLE)).alias(out),
    )
    on = F.col(quoted(item)).cast("string") == F.col("__to")
    for i, g in enumerate(group):
        on = on & F.col(quoted(g)).eqNullSafe(F.col(f"__g{i}"))
    found = df.join(roots.withColumnRenamed(out, "__root"), on, "left")
    return found.select(*[F.col(quoted(c)) for c in df.columns], F.coalesce("__root", F.lit(ORPHAN)).alias(out))
