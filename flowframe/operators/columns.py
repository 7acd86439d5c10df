"""Projection, predicate and column-shape operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def filter_rows(df: DataFrame, expr: str = "") -> DataFrame:
    """Keep rows for which a SQL predicate holds; an empty text keeps all of them."""
    return df.filter(expr) if expr.strip() else df


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def project(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Choose and rename columns; `pairs` is (from, name)."""
    return df.select(*[F.col(src).alias(name) for src, name in pairs])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def with_column(df: DataFrame, name: str, expr: str) -> DataFrame:
    return df.withColumn(name, F.expr(expr))


def with_columns(df: DataFrame, cols: Iterable[tuple[str, str]]) -> DataFrame:
    """Add (name, SQL expression) columns in order; a later one may read an earlier one.

    Expressions that do not mention a name of the running batch share one projection, so
    a hundred independent columns cost one analysis pass.
    """
    batch: dict[str, Column] = {}
    for name, expr in cols:
        mentioned = any(re.search(rf"(?i)\b{re.escape(n)}\b", expr) for n in batch)
        if mentioned or name in batch:
            df, batch = df.withColumns(batch), {}
        batch[name] = F.expr(expr)
    return df.withColumns(batch) if batch else df


def push_struct(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """Nest `cols` into one struct column and drop the originals."""
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest, F.struct(*cols).alias(name))


def pop_struct(df: DataFrame, col: str, keep_rest: bool = False) -> DataFrame:
    """Elevate the fields of a struct; other columns are dropped unless `keep_rest`."""
    if not keep_rest:
        return df.select(f"{quoted(col)}.*")
    rest = [c for c in df.columns if c != col]
    return df.select(*[F.col(quoted(c)) for c in rest], f"{quoted(col)}.*")


def explode_array(df: DataFrame, col: str, outer: bool = False) -> DataFrame:
    """One row per element of an array column; `outer` keeps rows with no element."""
    return df.withColumn(col, (F.explode_outer if outer else F.explode)(F.col(quoted(col))))


def explode_pop(df: DataFrame, col: str, keep_rest: bool = False) -> DataFrame:
    """Explode an array of structs and elevate the fields."""
    return pop_struct(explode_array(df, col), col, keep_rest)


def compact_fields(df: DataFrame) -> list[Column]:
    """The columns with empty text turned into null, so that JSON writers drop it."""
    return [
        F.nullif(F.col(quoted(f.name)), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(quoted(f.name))
        for f in df.schema.fields
    ]


def compact_json(df: DataFrame, out: str = "value", wrap: str = "data") -> DataFrame:
    """Each row as `{wrap: {...}}` JSON text without null or empty fields."""
    return df.select(F.to_json(F.struct(F.struct(*compact_fields(df)).alias(wrap))).alias(out))


def safe_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", name.strip())


def safe_column_names(df: DataFrame) -> DataFrame:
    """Rename every column to letters, digits and underscores only."""
    return df.toDF(*[safe_name(c) for c in df.columns])


def key_prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.filter(F.col(col).startswith(prefix))


def key_suffix_filter(df: DataFrame, col: str, suffix: str) -> DataFrame:
    return df.filter(F.col(col).endswith(suffix))


def key_contains(df: DataFrame, col: str, part: str) -> DataFrame:
    return df.filter(F.col(col).contains(part))


def key_in(df: DataFrame, col: str, values: Sequence, negate: bool = False) -> DataFrame:
    cond = F.col(col).isin(list(values))
    return df.filter(~cond if negate else cond)


def key_ranges(df: DataFrame, col: str, ranges: Iterable[tuple]) -> DataFrame:
    """Rows whose key lies in any half-open range [low, high); None is unbounded."""
    cond = F.lit(False)
    for low, high in ranges:
        part = F.lit(True)
        if low is not None:
            part = part & (F.col(col) >= F.lit(low))
        if high is not None:
            part = part & (F.col(col) < F.lit(high))
        cond = cond | part
    return df.filter(cond)
