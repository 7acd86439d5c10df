"""Mapping expressions as columns.

Values taken from documents are text. A missing value is null and, inside a function,
counts as empty text; arithmetic on text that is not a number counts it as zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character up to U+0020, which is what trimming removes
BLANKS = "".join(chr(i) for i in range(1, 33))


def text(x: Column) -> Column:
    """Text form, empty when missing."""
    return F.coalesce(x.cast("string"), F.lit(""))


def to_upper(x: Column) -> Column:
    return F.upper(text(x))


def to_lower(x: Column) -> Column:
    return F.lower(text(x))


def trim(x: Column) -> Column:
    return F.btrim(text(x), F.lit(BLANKS))


def concat(a: Column, b: Column) -> Column:
    return F.concat(text(a), text(b))


def join(sep: str, *args: Column) -> Column:
    """Arguments joined by the first; a missing one is empty, not skipped."""
    return F.concat_ws(sep, *[text(a) for a in args])


def matches(x: Column, pattern: str) -> Column:
    """True when the whole text matches the pattern."""
    return text(x).rlike(f"^(?:{pattern})$")


def substring(x: Column, start: int, stop: int) -> Column:
    """Characters from `start` up to but not including `stop`, counted from zero.

    With `stop` before `start` the text runs to its end. A range outside the text gives
    null, so the caller can reject the record.
    """
    whole = text(x)
    size = F.char_length(whole)
    if stop < start:
        return F.when(size >= start, F.substring(whole, F.lit(start + 1), size))
    return F.when(size >= stop, F.substring(whole, start + 1, stop - start))


def whole(x: Column) -> Column:
    return F.coalesce(x.cast("string").try_cast("bigint"), F.lit(0).cast("bigint"))


def real(x: Column) -> Column:
    return F.coalesce(x.cast("string").try_cast("double"), F.lit(0.0))


def plus(a: Column, b: Column, double: bool = False) -> Column:
    """Sum as whole numbers, or as doubles when an operand is a double literal or result."""
    return real(a) + real(b) if double else whole(a) + whole(b)


def minus(a: Column, b: Column, double: bool = False) -> Column:
    return real(a) - real(b) if double else whole(a) - whole(b)


def times(a: Column, b: Column, double: bool = False) -> Column:
    return real(a) * real(b) if double else whole(a) * whole(b)


def divide(a: Column, b: Column, double: bool = False) -> Column:
    """Integer quotient (towards zero) of whole numbers; null when divided by zero."""
    if double:
        return real(a) / F.nullif(real(b), F.lit(0.0))
    return F.call_function("div", whole(a), F.nullif(whole(b), F.lit(0).cast("bigint")))


def modulo(a: Column, b: Column, double: bool = False) -> Column:
    if double:
        return F.try_mod(real(a), real(b))
    return F.try_mod(whole(a), whole(b))


def round_half_up(x: Column) -> Column:
    """Nearest whole number, halves towards positive infinity."""
    return F.floor(real(x) + F.lit(0.5))


def compare(a: Column, op: str, b: Column) -> Column:
    """Compare text forms in text order; a missing value is empty text."""
    left, right = text(a), text(b)
    return {
        "==": left == right,
        "!=": left != right,
        "<": left < right,
        "<=": left <= right,
        ">": left > right,
        ">=": left >= right,
    }[op]


def truthy(x: Column, kind: str = "string") -> Column:
    """Non-empty text, a non-zero number, or a true boolean."""
    if kind == "string":
        return text(x) != ""
    if kind == "number":
        return F.coalesce(x, F.lit(0)) != 0
    return F.coalesce(x, F.lit(False))


def negate(x: Column) -> Column:
    return ~x


def both(a: Column, b: Column) -> Column:
    return a & b


def either(a: Column, b: Column) -> Column:
    return a | b


def choose(cond: Column, then: Column, other: Column | None = None) -> Column:
    return F.when(cond, then).otherwise(other if other is not None else F.lit(None))


def now() -> Column:
    """Epoch milliseconds, the same value throughout a query."""
    return F.unix_millis(F.current_timestamp())


def context(name: str, columns: list[str]) -> Column:
    """A named value of the row's context; an unbound name is its own text."""
    return F.col(name) if name in columns else F.lit(name)


def top_item(items: Column, item: str, parent: str, x: Column, root_marker: str = "000000") -> Column:
    """Root of item `x` within the items of one document.

    `items` is an array of structs with the fields `item` and `parent`. A pointer that leads
    to no item ends in `n/a`, one that runs in a circle in `cycle`. Across documents, use
    `operators.hierarchy.hierarchy_root`.
    """

    def step(acc: Column, _: Column) -> Column:
        mine = F.filter(items, lambda i: i[item].cast("string") == acc["at"])
        up = F.try_element_at(mine, F.lit(-1))[parent].cast("string")
        found = F.when(up.isNull(), F.lit("n/a")).when(up == root_marker, acc["at"])
        return F.struct(
            F.when(acc["root"].isNull(), F.coalesce(up, acc["at"])).otherwise(acc["at"]).alias("at"),
            F.coalesce(acc["root"], found).alias("root"),
        )

    start = F.struct(x.cast("string").alias("at"), F.lit(None).cast("string").alias("root"))
    # no chain is longer than the document has items
    walked = F.reduce(F.sequence(F.lit(1), F.size(items) + 1), start, step)
    return F.coalesce(walked["root"], F.lit("cycle"))
