"""Joins, set operators, branching, ordering."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.operators.columns import quoted

JOIN_TYPES = ("inner", "left", "right", "outer", "semi", "anti")


def join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named columns, which appear once and first.

    No hint is given: adaptive execution broadcasts a side only when its measured size
    allows, and splits skewed partitions otherwise.
    """
    return left.join(right, list(cols), how)


def join_on(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]], how: str = "left") -> DataFrame:
    """Equi-join on differently named columns; `pairs` is (left column, right column)."""
    return left.join(right, all_of(left[a] == right[b] for a, b in pairs), how)


def join_all(first: DataFrame, steps: Iterable[tuple[DataFrame, Sequence[str]]], how: str = "inner") -> DataFrame:
    """Chain of equi-joins: `steps` is (frame, columns)."""
    return reduce(lambda acc, step: join(acc, step[0], step[1], how), steps, first)


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def anti_join_null_safe(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows of `left` with no equal row in `right`.

    Null equals null, columns in `ignore` are not compared, and a column one side lacks
    counts as null there. The output has the sorted union of both column sets. The right
    side is made distinct first, so copies there neither travel nor pile up on a reducer.
    """
    wide_left, wide_right = align(left, right)
    compared = [c for c in wide_left.columns if c not in ignore]
    if not compared:
        raise ValueError("no column is left to compare")
    probe = wide_right.select(*[F.col(quoted(c)) for c in compared]).distinct()
    on = all_of(wide_left[quoted(c)].eqNullSafe(probe[quoted(c)]) for c in compared)
    return wide_left.join(probe, on, "left_anti")


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the sorted union of their columns, missing ones as typed nulls."""
    types = {**{f.name: f.dataType for f in right.schema}, **{f.name: f.dataType for f in left.schema}}
    names = sorted(types)

    def widen(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[F.col(quoted(c)) if c in have else F.lit(None).cast(types[c]).alias(c) for c in names]
        )

    return widen(left), widen(right)


def union(left: DataFrame | None, right: DataFrame | None, by_name: bool = False) -> DataFrame | None:
    """Union all by position; a missing side yields the other one."""
    if left is None or right is None:
        return left if right is None else right
    return left.unionByName(right) if by_name else left.union(right)


def union_ragged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union all of frames with different columns: sorted names, gaps as null."""
    wide_left, wide_right = align(left, right)
    return wide_left.unionByName(wide_right)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference: distinct rows of `left` that are not in `right`."""
    return left.subtract(right)


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def tee(df: DataFrame, n: int = 2) -> tuple[DataFrame, ...]:
    """The same lazy frame for several consumers."""
    return (df,) * n


def split(df: DataFrame, expr: str, distinct: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows for which the predicate is true, and the rest (false or null).

    `distinct` removes duplicates from the rest, as a set difference would.
    """
    hit = F.coalesce(F.expr(expr).cast("boolean"), F.lit(False))
    rest = df.filter(~hit)
    return df.filter(expr), rest.distinct() if distinct else rest


def sort(df: DataFrame, cols: str | Sequence[str], spread_ties: bool = True) -> DataFrame:
    """Order by column names; "-name" or "name desc" sorts descending.

    Rows with equal keys are ordered by their remaining columns: the order is then the same in
    every run, and a key with a large share of the rows is spread over several tasks.
    """
    keys = [cols] if isinstance(cols, str) else list(cols)
    order = [sort_key(k) for k in keys]
    if spread_ties:
        unordered = (T.MapType, T.VariantType)
        order += [F.col(quoted(f.name)) for f in df.schema if not holds_type(f.dataType, unordered)]
    return df.orderBy(*order)


def holds_type(kind: T.DataType, wanted: tuple) -> bool:
    """Whether a type is or contains one of the wanted types."""
    if isinstance(kind, wanted):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_type(kind.elementType, wanted)
    if isinstance(kind, T.StructType):
        return any(holds_type(f.dataType, wanted) for f in kind.fields)
    return False


def sort_key(key: str) -> Column:
    text = key.strip()
    if text.startswith("-"):
        return F.col(quoted(text[1:])).desc()
    head, _, tail = text.rpartition(" ")
    if head and tail.lower() in ("asc", "desc"):
        column = F.col(quoted(head.strip()))
        return column.desc() if tail.lower() == "desc" else column.asc()
    return F.col(quoted(text)).asc()


def sort_by_json_field(df: DataFrame, value: str, path: str) -> DataFrame:
    """Order messages by a whole number inside their JSON text, ties by the text; others are left out."""
    key = F.get_json_object(F.col(quoted(value)), path).try_cast("bigint")
    return df.withColumn("sort_key", key).filter("sort_key IS NOT NULL").orderBy("sort_key", quoted(value))


def limit(df: DataFrame, rows: int) -> DataFrame:
    return df.limit(rows)


def partition_sort(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None, split_hot: bool = True
) -> DataFrame:
    """Bring the rows of one key together, ordered by (keys, order), ready for a writer.

    By default rows are range-partitioned on keys and order, so a key that holds a large
    share of the rows runs over several adjacent partitions, each one sorted. With
    `split_hot=False` a key always stays inside one partition.
    """
    every = [*keys, *order]
    spread = every if split_hot else list(keys)
    if split_hot:
        moved = df.repartitionByRange(n, *spread) if n else df.repartitionByRange(*spread)
    else:
        moved = df.repartition(n, *spread) if n else df.repartition(*spread)
    return moved.sortWithinPartitions(*every)


def role_pivot(
    df: DataFrame, keys: Sequence[str], role: str, names: dict[str, dict[str, str]], ts: str, serial: str = "serial"
) -> DataFrame:
    """Turn one row per (key, role) into one row per key.

    `names` maps a role to {source column: output name}; `ts` is carried as `<role>_timestamp`
    and their greatest becomes `serial`. When a role occurs more than once the row with the
    highest timestamp wins. One partial aggregation replaces a self-join per role.
    """
    cols = sorted({c for mapping in names.values() for c in mapping})
    latest = [
        F.max(F.when(F.col(role) == r, F.struct(F.col(ts), *[F.col(c) for c in cols]))).alias(f"__{r}")
        for r in names
    ]
    wide = df.filter(F.col(role).isin(list(names))).groupBy(*keys).agg(*latest)
    out = [F.col(k) for k in keys]
    for r, mapping in names.items():
        out += [F.col(f"__{r}")[c].alias(name) for c, name in mapping.items()]
        out.append(F.col(f"__{r}")[ts].alias(f"{r}_timestamp"))
    stamps = [F.col(f"__{r}")[ts] for r in names]
    return wide.select(*out, (F.greatest(*stamps) if len(stamps) > 1 else stamps[0]).alias(serial))
