"""Rows gathered into sorted lists of structs.

A list is one value of one output row, so a group has to fit into a row. Where a group may
be larger, `max_items` cuts it: the group yields several numbered parts of about that many
structs, which together hold every row, and no task gathers the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators.columns import quoted


def nested_lists(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str, max_items: int | None = None, part_col: str = "part"
) -> DataFrame:
    """One row per key (or per key and part) with its rows as a sorted list of structs."""
    struct = F.struct(*[F.col(quoted(c)) for c in cols])
    if max_items is None:
        return df.groupBy(*keys).agg(F.sort_array(F.collect_list(struct)).alias(out))

    # Equal rows are counted on the map side; a row with very many copies becomes entries of
    # a sixteenth of a list each. An entry's part follows from its content, so a task that is
    # run again puts it into the same part.
    counted = df.groupBy(*[F.col(quoted(c)) for c in keys], struct.alias(out)).agg(F.count("*").alias("__copies"))
    step = F.lit(max(1, max_items // 16)).cast("bigint")
    entries = counted.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__copies") - 1) / step)))
    ).withColumn("__copies", F.least(step, F.col("__copies") - F.col("__chunk") * step))
    sizes = counted.groupBy(*[F.col(quoted(k)).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.ceil(F.sum("__copies") / F.lit(max_items)).alias("__parts")
    )
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(quoted(k)).eqNullSafe(F.col(f"__k{i}"))
    spread = entries.join(sizes, on).withColumn(
        part_col, F.pmod(F.xxhash64(out, "__chunk"), F.col("__parts"))
    )
    repeated = F.collect_list(F.array_repeat(F.col(out), F.col("__copies").cast("int")))
    return spread.groupBy(*keys, part_col).agg(F.sort_array(F.flatten(repeated)).alias(out))


def push_struct_array(
    df: DataFrame, name: str, cols: Sequence[str], max_items: int | None = None, part_col: str = "part"
) -> DataFrame:
    """Group by all other columns and nest `cols` as a sorted array of structs."""
    rest = [c for c in df.columns if c not in cols]
    if not rest:
        raise ValueError("push_struct_array needs at least one column to group by")
    return nested_lists(df, rest, cols, name, max_items, part_col)


def collect_children(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str, max_items: int | None = None
) -> DataFrame:
    """One row per key with its child rows as a sorted array of structs."""
    return nested_lists(df, keys, cols, out, max_items)
