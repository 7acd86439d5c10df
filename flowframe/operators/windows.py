"""Ordered neighbours within a key that stay spread over tasks.

Keys are cut into buckets that follow the order (a month of a timestamp, a block of a number):
the window runs per bucket, and an aggregate of one row per bucket carries values over the
bucket borders. So the rows of a large key are never in one task, and all keys take one path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = "__key"
PLACE = "__place"


@dataclass(frozen=True)
class Wanted:
    """New columns {name: source column} by the kind of neighbour they come from."""

    order: tuple[str, ...]
    following: dict[str, str]
    carried: dict[str, str]
    highest: dict[str, str]

    @property
    def names(self) -> list[str]:
        return [*self.following, *self.carried, *self.highest]

    @property
    def next_values(self) -> Column:
        """What a row hands to the one before it."""
        return F.struct(*[F.col(c).alias(n) for n, c in self.following.items()]) if self.following else F.lit(None)


def ordered_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    following: Mapping[str, str] | None = None,
    carried: Mapping[str, str] | None = None,
    highest: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add columns {new name: column} taken from other rows of the key.

    `following` is the value of the next row in order, null on the last one. `carried` is the
    row's own value or the last one before it that is not null. `highest` is the maximum over
    the key. `bucket` must not decrease along `order`. Rows that are equal in `order` follow each
    other by the values that are handed on. Null keys are equal.
    """
    follow, carry = dict(following or {}), dict(carried or {})
    ties = [c for c in dict.fromkeys([*follow.values(), *carry.values()]) if c not in order]
    want = Wanted((*order, *ties), follow, carry, dict(highest or {}))
    rows = df.withColumn(KEY, F.struct(*[F.col(k) for k in keys]))
    return bucketed_neighbours(rows, bucket, want).select(*df.columns, *want.names)


def bucketed_neighbours(rows: DataFrame, bucket: Column, want: Wanted) -> DataFrame:
    """Key and bucket are one struct; the row windows and the join share its partitioning."""
    rows = rows.withColumn(PLACE, F.struct(F.col(KEY).alias("key"), bucket.alias("bucket")))
    order = [F.col(c).alias(f"o{i}") for i, c in enumerate(want.order)]

    facts = {"__head": F.min(F.struct(*order, want.next_values.alias("v")))["v"]}
    for n, c in want.carried.items():
        facts[f"__tail_{n}"] = F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("v"))))["v"]
    for n, c in want.highest.items():
        facts[f"__top_{n}"] = F.max(c)
    told = rows.groupBy(PLACE).agg(*[v.alias(n) for n, v in facts.items()])

    across = W.partitionBy(f"{PLACE}.key").orderBy(f"{PLACE}.bucket")
    earlier = across.rowsBetween(W.unboundedPreceding, -1)
    border = {"__after": F.lead("__head").over(across)}
    border.update({f"__before_{n}": F.last(f"__tail_{n}", ignorenulls=True).over(earlier) for n in want.carried})
    border.update({n: F.max(f"__top_{n}").over(W.partitionBy(f"{PLACE}.key")) for n in want.highest})
    told = told.select(PLACE, *[v.alias(n) for n, v in border.items()])

    inside = W.partitionBy(PLACE).orderBy(*want.order)
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    near = {f"__own_{n}": F.last(c, ignorenulls=True).over(so_far) for n, c in want.carried.items()}
    if want.following:
        near["__next"] = F.lead(want.next_values).over(inside)
    joined = rows.withColumns(near).join(told, PLACE)
    out = {n: F.coalesce("__next", "__after")[n] for n in want.following}
    out.update({n: F.coalesce(f"__own_{n}", f"__before_{n}") for n in want.carried})
    return joined.withColumns(out)
