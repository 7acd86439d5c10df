"""A wide keyed table kept as a log of cells: (row_key, family, qualifier, ts, value).

Rows are read back by conditional aggregation over a known list of qualifiers: one shuffle
with map-side combine, and a filter on the qualifiers and keys below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.operators.columns import quoted
from flowframe.operators.relational import all_of

CELL = ["row_key", "family", "qualifier"]


def needed(cells: DataFrame, qualifiers: Sequence[str], family: str | None) -> DataFrame:
    df = cells.filter(F.col("qualifier").isin(list(qualifiers)))
    return df.filter(F.col("family") == family) if family else df


def newest_value(qualifier: str) -> Column:
    """Value of the newest cell of a qualifier; the greater value breaks a tie."""
    pair = F.when(F.col("qualifier") == qualifier, F.struct("ts", "value"))
    return F.max(pair)["value"].alias(qualifier)


def cells_latest(cells: DataFrame, qualifiers: Sequence[str], family: str | None = None) -> DataFrame:
    """One row per key with the newest value of each qualifier."""
    return needed(cells, qualifiers, family).groupBy("row_key").agg(*[newest_value(q) for q in qualifiers])


def cells_versions(cells: DataFrame, qualifiers: Sequence[str], n: int, family: str | None = None) -> DataFrame:
    """The newest `n` versions of each cell, one row per (key, version timestamp).

    A qualifier without a version at exactly that timestamp is null there.
    """
    return (
        newest_versions(needed(cells, qualifiers, family), n)
        .groupBy("row_key", "ts")
        .agg(*[newest_value(q) for q in qualifiers])
    )


def newest_versions(cells: DataFrame, n: int) -> DataFrame:
    """The newest `n` distinct versions of each cell.

    Writing the same (cell, timestamp) twice keeps one version. The rank limit is applied on
    the map side first, so a key with very many versions sends only `n` per task.
    """
    once = cells.groupBy(*CELL, "ts").agg(F.max("value").alias("value"))
    rank = F.row_number().over(W.partitionBy(*CELL).orderBy(F.col("ts").desc()))
    return once.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def cells_as_of(cells: DataFrame, ts) -> DataFrame:
    """Cells written at exactly `ts`."""
    return cells.filter(F.col("ts") == F.lit(ts))


def cells_between(cells: DataFrame, low, high) -> DataFrame:
    """Cells written in [low, high)."""
    return cells.filter((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high)))


def cells_in(cells: DataFrame, at=None, low=None, high=None) -> DataFrame:
    """A point or a range; both together are an error."""
    if at is not None and (low is not None or high is not None):
        raise ValueError("give a point in time or a range, not both")
    if at is not None:
        return cells_as_of(cells, at)
    if low is not None and high is not None:
        return cells_between(cells, low, high)
    if low is not None or high is not None:
        raise ValueError("a range needs both ends")
    return cells


def cells_dynamic_map(
    cells: DataFrame, family: str, versions: bool = False, max_cells: int | None = None, part_col: str = "part"
) -> DataFrame:
    """All qualifiers of a family as a map, or as a map of {version timestamp: value} maps.

    A map is one value of a row. Where a row may hold more cells than fit into one, `max_cells`
    cuts it into numbered parts of about that many, which together hold every cell; which part a
    cell goes to follows from its qualifier and version.
    """
    mine = cells.filter(F.col("family") == family)
    place = ["qualifier", "ts"] if versions else ["qualifier"]
    if versions:
        once = mine.groupBy("row_key", *place).agg(F.max("value").alias("value"))
    else:
        once = mine.groupBy("row_key", *place).agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    keys = ["row_key"]
    if max_cells is not None:
        sizes = once.groupBy("row_key").agg(F.ceil(F.count("*") / F.lit(max_cells)).alias("__parts"))
        once = once.join(sizes, "row_key").withColumn(part_col, F.pmod(F.xxhash64(*place), F.col("__parts")))
        keys.append(part_col)
    if not versions:
        entries = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
        return once.groupBy(*keys).agg(F.map_from_entries(entries).alias("cells"))
    by_cell = once.groupBy(*keys, "qualifier").agg(F.array_sort(F.collect_list(F.struct("ts", "value"))).alias("v"))
    entries = by_cell.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("qualifier", "v"))).alias("e"))
    as_map = F.transform("e", lambda x: F.struct(x["qualifier"], F.map_from_entries(x["v"])))
    return entries.select(*keys, F.map_from_entries(as_map).alias("cells"))


def cells_from_frame(df: DataFrame, key: Column | str, ts: Column | str, families: dict[str, str]) -> DataFrame:
    """A frame as cells; `families` is {column: family}. A null value writes no cell.

    A map column expands: {qualifier: value}, or {qualifier: {version: value}}.
    """
    key = F.col(key) if isinstance(key, str) else key
    ts = F.col(ts) if isinstance(ts, str) else ts
    types = {f.name: f.dataType for f in df.schema}
    cell = "array<struct<family:string,qualifier:string,ts:{t},value:string>>"
    ts_type = df.select(ts.alias("t")).schema["t"].dataType.simpleString()
    arrays = []
    for name, family in families.items():
        made = cell_array(F.col(quoted(name)), types[name], name, F.lit(family), ts, ts_type)
        arrays.append(F.coalesce(made, F.array()).cast(cell.format(t=ts_type)))
    every = F.filter(F.concat(*arrays), lambda c: c["value"].isNotNull())
    return df.select(key.alias("row_key"), F.explode(every).alias("c")).select("row_key", "c.*")


def cell_array(column: Column, kind: T.DataType, name: str, family: Column, ts: Column, ts_type: str) -> Column:
    """The cells one column of a row makes."""
    if not isinstance(kind, T.MapType):
        return F.array(F.struct(family, F.lit(name), ts, column.cast("string")))
    if not isinstance(kind.valueType, T.MapType):
        return F.transform(
            F.map_entries(column), lambda e: F.struct(family, e["key"], ts, e["value"].cast("string"))
        )

    def versions(entry: Column) -> Column:
        return F.transform(
            F.map_entries(entry["value"]),
            lambda v: F.struct(family, entry["key"], v["key"].cast(ts_type), v["value"].cast("string")),
        )

    return F.flatten(F.transform(F.map_entries(column), versions))


def mapped_cells(rows: DataFrame, ts: str = "sort_key") -> DataFrame:
    """Mapped rows (with their cells map) as a log of cells."""
    return rows.select("table_name", "row_key", "family", F.explode("cells").alias("qualifier", "value"), F.col(ts).alias("ts"))


def upsert_with_lookback(history: DataFrame, batch: DataFrame, n: int) -> DataFrame:
    """Rows of `batch` whose dedup hash is not among the last `n` stored for their key.

    `history` holds (row_key, ts, dedup_key). Rows without a hash always pass.
    """
    last = last_hashes(history, n)
    on = [batch["row_key"] == last["row_key"], batch["dedup_key"] == last["dedup_key"], batch["dedup_key"] != ""]
    return batch.join(last, all_of(on), "left_anti")


def last_hashes(history: DataFrame, n: int) -> DataFrame:
    order = [F.col("ts").desc(), F.col("dedup_key").desc()]
    rank = F.row_number().over(W.partitionBy("row_key").orderBy(*order))
    return history.withColumn("__rank", rank).filter(F.col("__rank") <= n).select("row_key", "dedup_key").distinct()


def batch_last_write_wins(cells: DataFrame, keys: Sequence[str], order: str, value: str = "value") -> DataFrame:
    """Within a batch the cell with the highest sort key wins; the greater value breaks a tie."""
    last = F.max(F.struct(F.col(order), F.col(value)))
    return cells.groupBy(*keys).agg(last[order].alias(order), last[value].alias(value))


def latest_versions(df: DataFrame, key: str, version: str, value: str) -> DataFrame:
    """The newest version of each key."""
    last = F.max(F.struct(F.col(version), F.col(value)))
    return df.groupBy(key).agg(last[version].alias(version), last[value].alias(value))
