"""Paths into parsed JSON as columns.

A document is parsed once to a VARIANT. `path(doc)` starts with the whole document and each
step narrows or widens the list of matches; everything is built from higher-order functions
and stays in one projection:

    path(F.col("doc")).field("lines").each().where(lambda x: gt(x, "qty", 3)).field("sku").first()
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANTS = "array<variant>"
FIELDS = "map<string,variant>"
#: In JSON text, each bracket that opens.
OPENING = r"[\[{]"


def no_matches() -> Column:
    return F.array().cast(VARIANTS)


def elements(value: Column) -> Column:
    """Elements of an array value; none for anything else."""
    return F.coalesce(F.try_variant_get(value, "$", VARIANTS), no_matches())


def members(value: Column) -> Column:
    """Field values of an object, in key order; none for anything else."""
    return F.coalesce(F.map_values(F.try_variant_get(value, "$", FIELDS)), no_matches())


def step(name: str) -> str:
    """A field name as one path step."""
    return "$['" + name.replace("'", "\\'") + "']"


def field_of(value: Column, name: str) -> Column:
    return F.try_variant_get(value, step(name), "variant")


def field_text(value: Column, name: str) -> Column:
    return F.try_variant_get(value, step(name), "string")


def one_list(*lists: Column) -> Column:
    """The items of several lists, none of them null. (`concat` evaluates lists many times slower.)"""
    return F.flatten(F.array(*lists))


def most_levels(values: Column) -> Column:
    """At least as many as the levels of a list of values: the brackets that open in its JSON text."""
    return F.regexp_count(F.coalesce(F.to_json(values), F.lit("[]")), F.lit(OPENING))


class Matches:
    """The list of values a path matches in one document."""

    def __init__(self, values: Column):
        self.values = values

    def _expand(self, f: Callable[[Column], Column]) -> Matches:
        return Matches(F.flatten(F.transform(self.values, f)))

    def field(self, name: str) -> Matches:
        found = F.transform(self.values, lambda v: field_of(v, name))
        return Matches(F.filter(found, lambda v: v.isNotNull()))

    def fields(self, *names: str) -> Matches:
        """Several named fields of each value, in the order given."""
        return self._expand(
            lambda v: F.filter(F.array(*[field_of(v, n) for n in names]), lambda x: x.isNotNull())
        )

    def any_field(self) -> Matches:
        return self._expand(members)

    def each(self) -> Matches:
        return self._expand(elements)

    def index(self, *positions: int) -> Matches:
        """Array elements by position; negative positions count from the end."""

        def pick(v: Column) -> Column:
            array = elements(v)
            picked = [F.try_element_at(array, F.lit(i + 1 if i >= 0 else i)) for i in positions]
            return F.filter(F.array(*picked), lambda x: x.isNotNull())

        return self._expand(pick)

    def slice(self, start: int | None = None, stop: int | None = None, step: int = 1) -> Matches:
        """Elements from `start` up to `stop`, every `step`-th.

        Bounds below zero count from the end. With a negative step the array is walked from
        its end and the bounds mirror: element -1 is then at position 0.
        """

        def bound(x: int | None, size: Column, default: Column) -> Column:
            if x is None:
                return default
            mirrored = x if step >= 0 else -1 - x
            return F.lit(mirrored) if mirrored >= 0 else size + F.lit(mirrored)

        def cut(array: Column) -> Column:
            size = F.size(array)
            walked = F.reverse(array) if step < 0 else array
            low = F.greatest(bound(start, size, F.lit(0)), F.lit(0))
            high = bound(stop, size, size)
            # bounds are worked out once for an array, not for each of its elements
            picked = F.slice(walked, low + 1, F.greatest(high - low, F.lit(0)))
            return picked if abs(step) == 1 else F.filter(picked, lambda _, i: i % F.lit(abs(step)) == 0)

        return Matches(F.flatten(F.transform(F.transform(self.values, elements), cut)))

    def where(self, predicate: Callable[[Column], Column]) -> Matches:
        """Elements of an array value (or an object itself) for which the predicate is true."""

        def keep(v: Column) -> Column:
            items = F.coalesce(
                F.try_variant_get(v, "$", VARIANTS),
                F.when(F.try_variant_get(v, "$", FIELDS).isNotNull(), F.array(v)),
                no_matches(),
            )
            return F.filter(items, lambda x: F.coalesce(predicate(x), F.lit(False)))

        return self._expand(keep)

    def levels(self, expand: Callable[[Column], Column], inside: str, hit: str) -> Matches:
        """Walk down level by level, as deep as the document is.

        `expand` makes a struct of lists of each node, once: those at `inside` are the next level, those
        at `hit` are gathered.
        """
        start = F.struct(self.values.alias("frontier"), F.array().cast(f"array<{VARIANTS}>").alias("found"))

        def descend(acc: Column, _: Column) -> Column:
            def walked(nodes: Column) -> Column:
                found = F.array_append(acc["found"], F.flatten(nodes[hit]))
                return F.struct(F.flatten(nodes[inside]).alias("frontier"), found.alias("found"))

            below = F.transform(F.array(F.transform(acc["frontier"], expand)), walked)
            return F.when(F.size(acc["frontier"]) > 0, F.element_at(below, 1)).otherwise(acc)

        steps = F.array_repeat(F.lit(0), most_levels(self.values))
        return Matches(F.reduce(steps, start, descend, lambda acc: F.flatten(acc["found"])))

    def deep_field(self, name: str) -> Matches:
        """Fields of that name at any depth; a matched value is not searched further."""

        def expand(v: Column) -> Column:
            others = F.map_filter(F.try_variant_get(v, "$", FIELDS), lambda k, _: k != name)
            below = F.coalesce(F.map_values(others), elements(v))
            return F.struct(below.alias("inside"), F.filter(F.array(field_of(v, name)), lambda x: x.isNotNull()).alias("hit"))

        return self.levels(expand, "inside", "hit")

    def deep_any(self) -> Matches:
        """The value itself and every field value at any depth."""

        def expand(v: Column) -> Column:
            return F.struct(one_list(elements(v), members(v)).alias("inside"), members(v).alias("hit"))

        return Matches(one_list(self.values, self.levels(expand, "inside", "hit").values))

    def deep_where(self, predicate: Callable[[Column], Column]) -> Matches:
        """Objects at any depth for which the predicate is true."""

        def expand(v: Column) -> Column:
            hit = F.filter(F.array(v), lambda x: (F.size(members(x)) > 0) & F.coalesce(predicate(x), F.lit(False)))
            return F.struct(one_list(elements(v), members(v)).alias("inside"), hit.alias("hit"))

        return self.levels(expand, "inside", "hit")

    def first(self) -> Column:
        """Text of the first match, null without one."""
        return variant_text(F.try_element_at(self.values, F.lit(1)))

    def joined(self, sep: str = "") -> Column:
        """Texts of all matches in one text."""
        return F.array_join(F.transform(self.values, variant_text), sep)

    def count(self) -> Column:
        return F.size(self.values)


def path(doc: Column) -> Matches:
    return Matches(F.filter(F.array(doc), lambda v: v.isNotNull()))


def variant_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def has(value: Column, name: str) -> Column:
    """Existence test for a filter."""
    return field_of(value, name).isNotNull()


def same_text(value: Column, name: str, expected: str) -> Column:
    """Typed comparison with a text: a number or boolean is never equal to it."""
    is_text = F.schema_of_variant(field_of(value, name)) == "STRING"
    return is_text & (field_text(value, name) == expected)


def same_bool(value: Column, name: str, expected: bool) -> Column:
    is_bool = F.schema_of_variant(field_of(value, name)) == "BOOLEAN"
    return is_bool & (field_text(value, name) == str(expected).lower())


def number_of(value: Column, name: str) -> Column:
    """The field as a number, null when it is not one."""
    kind = F.schema_of_variant(field_of(value, name))
    is_number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(is_number, F.try_variant_get(value, step(name), "double"))
