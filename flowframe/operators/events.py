"""Aggregation and event-time shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.operators.columns import quoted
from flowframe.operators.relational import holds_type, join


def orderable(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Columns in a form that can be ordered, for full tie-breaks."""
    types = {f.name: f.dataType for f in df.schema}
    unordered = (T.MapType, T.VariantType)
    return [
        F.to_json(F.struct(F.col(quoted(c)))) if holds_type(types[c], unordered) else F.col(quoted(c)) for c in cols
    ]


def freshest_rows(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """For each key, all rows that carry its highest timestamp.

    The maxima come from a partial aggregation. The join back is on keys *and* timestamp:
    a key with a large share of the rows is spread over its timestamps instead of landing
    on one reducer, and adaptive execution broadcasts the maxima when they are small.
    """
    best = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return join(df, best, [*keys, ts])


def current_state(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Freshest distinct rows per key; a key column may itself be the timestamp."""
    best = df.groupBy(*keys).agg(F.max(ts).alias("__max_ts"))
    rows = df.distinct().withColumn("__max_ts", F.col(ts))
    return join(rows, best, [*keys, "__max_ts"]).select(*df.columns)


def dedup_oldest(df: DataFrame, ts: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Among rows equal in all columns but `ts` and `ignore`, keep the oldest.

    A null timestamp counts as the oldest. The ignored columns come from the kept row. A
    plain aggregation combines copies before the shuffle, however many there are.
    """
    compared = [c for c in df.columns if c != ts and c not in ignore]
    carried = [ts, *[c for c in df.columns if c in ignore]]
    if not compared:
        raise ValueError("no column is left to compare")
    group = [F.col(quoted(c)) for c in compared]
    if carried == [ts]:
        oldest = F.when(F.count("*") == F.count(ts), F.min(ts))
        return df.groupBy(*group).agg(oldest.alias(ts)).select(*[F.col(quoted(c)) for c in df.columns])
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(orderable(df, carried))])
    row = F.struct(*[F.col(quoted(c)) for c in carried])
    best = df.groupBy(*group).agg(F.min_by(row, order).alias("__row"))
    return best.select(
        *[F.col("__row")[c].alias(c) if c in carried else F.col(quoted(c)) for c in df.columns]
    )


def earliest_per_row(df: DataFrame, ts: str) -> DataFrame:
    """Collapse rows equal in all other columns to their earliest timestamp."""
    rest = [c for c in df.columns if c != ts]
    return df.groupBy(*rest).agg(F.min(ts).alias(ts)).select(*df.columns)


def event_serial(df: DataFrame, stamps: Sequence[str], out: str = "serial") -> DataFrame:
    """The greatest of several timestamps; nulls are skipped."""
    return df.withColumn(out, F.greatest(*stamps) if len(stamps) > 1 else F.col(stamps[0]))


def to_events(
    df: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, event_ts: str, strict_compat: bool = False
) -> DataFrame:
    """A joined frame as timestamped events, one row per (keys, event timestamp).

    The event timestamp is the greater of the two sides. Of several rows with the same
    event, the one with the highest right and then left timestamp stays; the remaining
    columns break ties. `row_number() = 1` is cut down on the map side before the shuffle.

    `strict_compat` reproduces the two-step maximum, which can leave two rows and drops
    rows where a side has no timestamp.
    """
    rows = df.withColumn(event_ts, F.greatest(left_ts, right_ts))
    if strict_compat:
        # Of an event's rows one side or both have its timestamp. The highest right side per left side, and of
        # these the highest left side per right side, leave the best of either kind; a row where both sides
        # have the timestamp is the best of both.
        event, left, right = F.col(event_ts), F.col(left_ts), F.col(right_ts)
        for name in (*keys, left_ts, right_ts):
            rows = rows.filter(F.col(name).isNotNull())
        same = W.partitionBy(*keys, event_ts)
        best = rows.withColumns(
            {
                "__right": F.max(F.when(left == event, right)).over(same),
                "__left": F.max(F.when(right == event, left)).over(same),
            }
        ).filter(((left == event) & (right == F.col("__right"))) | ((right == event) & (left == F.col("__left"))))
        first = [*keys, event_ts, left_ts, right_ts]
        return best.select(*first, *[c for c in df.columns if c not in first])
    rest = [c for c in df.columns if c not in (*keys, left_ts, right_ts)]
    order = [F.col(right_ts).desc_nulls_last(), F.col(left_ts).desc_nulls_last()]
    order += [c.desc_nulls_last() for c in orderable(rows, rest)]
    rank = F.row_number().over(W.partitionBy(*keys, event_ts).orderBy(*order))
    return rows.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def join_to_events(
    left: DataFrame,
    right: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    event_ts: str,
    how: str = "inner",
    strict_compat: bool = False,
) -> DataFrame:
    """Join two timestamped frames and shape the result into events."""
    return to_events(join(left, right, cols, how), keys, left_ts, right_ts, event_ts, strict_compat)


def first_seen_value(df: DataFrame, keys: Sequence[str], value: str, serial: str = "serial") -> DataFrame:
    """The earliest serial at which each value of a key was seen; null values are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(serial).alias(serial))


def group_count(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct topics or table names of a batch."""
    return df.select(col).distinct()
