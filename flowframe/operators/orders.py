"""Event tables and nested objects of an order process.

The functions are generic: tables, keys and columns are parameters. Classifications are
ordered lists of (label, condition), the first that holds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowframe.operators.columns import quoted
from flowframe.operators.events import event_serial, first_seen_value
from flowframe.operators.nesting import nested_lists
from flowframe.operators.relational import join, join_all, role_pivot


# --- event tables ----------------------------------------------------------------------


def event_details(header: DataFrame, line: DataFrame, keys: Sequence[str], stamps: Sequence[str]) -> DataFrame:
    """Header joined to its lines, with the later change of the two as serial."""
    return event_serial(join(header, line, keys), stamps)


def event_status(
    log: DataFrame,
    profile: tuple[DataFrame, Sequence[str]],
    texts: tuple[DataFrame, Sequence[str]],
    number: str,
    parts: Mapping[str, tuple[int, int]],
    item: str,
    stamps: Sequence[str],
    header_item: str = "000000",
) -> DataFrame:
    """Status log with object profile and status texts.

    The composite object number is cut into `parts` {name: (position, length)}; an item part
    equal to `header_item` marks a header status.
    """
    joined = join_all(log, [profile, texts])
    cut = joined.withColumns({n: F.substring(number, p, length) for n, (p, length) in parts.items()})
    kind = F.when(F.col(item) == header_item, F.lit("header")).otherwise(F.lit("item"))
    return event_serial(cut.withColumn("statustype", kind), stamps)


def event_partner(
    partner: DataFrame,
    address: tuple[DataFrame, Sequence[str]],
    keys: Sequence[str],
    role: str,
    names: dict[str, dict[str, str]],
    ts: str,
) -> DataFrame:
    """One row per document with the address of each partner role."""
    wanted = partner.filter(F.col(role).isin(list(names)))
    return role_pivot(join(wanted, address[0], address[1]), keys, role, names, ts)


def event_schedule(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("serial", F.col(ts))


def event_delivery(
    header: DataFrame, line: DataFrame, keys: Sequence[str], header_needs: str, line_needs: str, stamps: Sequence[str]
) -> DataFrame:
    """Delivery headers with a date joined to lines with an order reference."""
    dated, referring = header.filter(F.col(header_needs).isNotNull()), line.filter(F.col(line_needs).isNotNull())
    return event_serial(join(dated, referring, keys), stamps)


def event_purchase(
    header: DataFrame, item: tuple[DataFrame, Sequence[str]], link: tuple[DataFrame, Sequence[str]], stamps: Sequence[str]
) -> DataFrame:
    return event_serial(join_all(header, [item, link]), stamps)


def load_events_since(df: DataFrame, start: str, serial: str = "serial") -> DataFrame:
    """Event rows changed after `start`; the filter reaches the scan."""
    return df.filter(F.col(serial) > F.lit(start))


def split_scopes(status: DataFrame, item: str, kind: str = "statustype") -> tuple[DataFrame, DataFrame]:
    """Header statuses (without the item column) and item statuses."""
    return status.filter(F.col(kind) == "header").drop(item), status.filter(F.col(kind) == "item")


def flagged_lookup(df: DataFrame, key: str, name: str, flag: str, value: str = "Y") -> DataFrame:
    """Distinct trimmed keys of a lookup with a flag column."""
    return df.select(F.trim(F.col(key)).alias(name)).distinct().withColumn(flag, F.lit(value))


# --- nested objects --------------------------------------------------------------------


Children = Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]
Required = Sequence[tuple[DataFrame, Sequence[str]]]


def attach_list(parent: DataFrame, nested: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Left join of a list column; a parent without children has an empty list."""
    empty = F.array().cast(nested.schema[name].dataType)
    return join(parent, nested, keys, "left").withColumn(name, F.coalesce(name, empty))


def assemble(parent: DataFrame, children: Children, required: Required = ()) -> DataFrame:
    """Parent rows with their children as lists, in one column per kind of child.

    `children` is {list name: (child rows, key columns, kept columns)}; `required` frames are
    joined as they are and must match. Each child is aggregated on its own key before the
    join, so lists never multiply each other and parent rows never serve as a grouping key.
    """
    out = parent
    for name, (child, keys, cols) in children.items():
        out = attach_list(out, nested_lists(child, keys, cols, name), keys, name)
    return join_all(out, required)


def assemble_bounded(
    parent: DataFrame, children: Children, max_items: int, required: Required = ()
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """`assemble` for parents that may have more children than fit into a row.

    The objects carry lists of about `max_items`. Children beyond them are in the second
    result, per list name: (keys, part, list), with parts numbered from 1.
    """
    out, overflow = parent, {}
    for name, (child, keys, cols) in children.items():
        parts = nested_lists(child, keys, cols, name, max_items)
        out = attach_list(out, parts.filter("part = 0").drop("part"), keys, name)
        overflow[name] = parts.filter("part > 0")
    return join_all(out, required), overflow


def status_scope_union(
    parent: DataFrame, headers: DataFrame, items: DataFrame, header_keys: Sequence[str], item_keys: Sequence[str]
) -> DataFrame:
    """Header statuses for every item of the document, item statuses for their own item."""
    keys = parent.select(*item_keys)
    by_header = join(keys, headers, header_keys)
    by_item = join(keys, items, item_keys)
    return by_header.unionByName(by_item.select(*by_header.columns))


def assemble_delivery(
    lines: DataFrame,
    shipments: DataFrame,
    keys: Sequence[str],
    line_cols: Sequence[str],
    own_id: str,
    external_id: str,
    use_external: Column,
    shipment_id: str,
    shipment_cols: Sequence[str],
    dates: DataFrame | None = None,
    date_keys: Sequence[str] = (),
    date: str = "",
    serial: str = "serial",
    keep_undated: bool = False,
    lists: Callable[[DataFrame, Sequence[str], Sequence[str], str], DataFrame] = nested_lists,
) -> DataFrame:
    """Deliveries with lists of lines, of shipments and of the dates first seen.

    A delivery refers to shipments by its external id where `use_external` holds and the id is
    given, and by its own id otherwise. Deliveries without any date are dropped unless
    `keep_undated`. `lists` makes the lists, as `nested_lists` does.
    """
    whole = lists(lines, keys, line_cols, "line_list")
    match = F.when(use_external & F.col(external_id).isNotNull(), F.col(external_id)).otherwise(F.col(own_id))
    ships = lists(shipments, [shipment_id], shipment_cols, "shipment_list")
    ships = ships.withColumnRenamed(shipment_id, "__match")
    out = attach_list(whole.withColumn("__match", match), ships, ["__match"], "shipment_list").drop("__match")
    if dates is None:
        return out
    seen = first_seen_value(dates, date_keys, date, serial)
    dated = lists(seen, date_keys, [date, serial], "date_list")
    return attach_list(out, dated, date_keys, "date_list") if keep_undated else join(out, dated, date_keys)


def assemble_delivery_bounded(*args, max_items: int, **kwargs) -> tuple[DataFrame, dict[str, DataFrame]]:
    """`assemble_delivery` for deliveries that may have more entries than fit into a row.

    The objects carry lists of about `max_items`. What is beyond them is in the second result, per
    list name: (keys of the list, part, list).
    """
    overflow: dict[str, DataFrame] = {}

    def lists(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str) -> DataFrame:
        parts = nested_lists(df, keys, cols, name, max_items)
        # the first part there is stands in the object, so every delivery has one
        parts = parts.withColumn("__first", F.min("part").over(W.partitionBy(*keys)))
        overflow[name] = parts.filter("part > __first").drop("__first")
        return parts.filter("part = __first").drop("part", "__first")

    return assemble_delivery(*args, lists=lists, **kwargs), overflow


# --- classification --------------------------------------------------------------------


def decide(rules: Sequence[tuple[str, Column | str]], default: str | None = None) -> Column:
    """The label of the first rule whose condition is true.

    Rules are the caller's data: pairs of a label and a condition, as a column or as SQL text.
    """
    chain: Column | None = None
    for label, given in rules:
        cond = F.expr(given) if isinstance(given, str) else given
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    if chain is None:
        return F.lit(default)
    return chain.otherwise(F.lit(default))


def group_facts(lines: DataFrame, keys: Sequence[str], facts: Mapping[str, Column | str], count: str = "line_count") -> DataFrame:
    """Per group: its number of lines, and for each fact whether any line satisfies it."""
    conds = {n: F.expr(c) if isinstance(c, str) else c for n, c in facts.items()}
    made = [F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in conds.items()]
    return lines.groupBy(*keys).agg(F.count("*").alias(count), *made)


def classify_group(
    roots: DataFrame,
    lines: DataFrame,
    keys: Sequence[str],
    facts: Mapping[str, Column | str],
    rules: Sequence[tuple[str, Column | str]],
    default: str,
    out: str,
) -> DataFrame:
    """Label root rows by an ordered list of rules over the root and facts about its lines.

    The facts are booleans and counts combined on the map side; lines are never gathered.
    """
    told = join(roots, group_facts(lines, keys, facts), keys, "left")
    told = told.na.fill(0, ["line_count"]).na.fill(False, list(facts))
    return told.withColumn(out, decide(rules, default)).drop("line_count", *facts)


def lookup_enrich(
    df: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str]]],
    missing: str = "_",
) -> DataFrame:
    """Left joins to lookup tables; text that is missing becomes `missing`.

    Adaptive execution broadcasts a lookup where its measured bytes allow.
    """
    return join_all(df, lookups, "left").na.fill(missing)


def json_keyed(df: DataFrame, fields: Sequence[str], value: str = "value", out: str = "json") -> DataFrame:
    """JSON text with some of its top-level fields as columns in front."""
    return df.select(F.json_tuple(F.col(value), *fields).alias(*fields), F.col(value).alias(out))


def result_rows(df: DataFrame, key: Sequence[str], version: str, out: str = "json") -> DataFrame:
    """Processed objects as (row key, JSON); the key ends in the rule version."""
    whole = F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]))
    return df.select(F.concat_ws("_", *key, F.lit(version)).alias("row_key"), whole.alias(out))
