"""Values of mapping specs: helper functions, and which records a value fails in.

The helpers of mapping specs are written out as Spark SQL. What a value's expression casts,
by itself or because of the types it puts together, is read from Spark's own analysis of it; each
cast is then tried, and a condition tells whether one of those that are reached failed. So a bad
value neither stops the job nor turns into a missing one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.functions.mapexpr import BLANKS

QUOTED = r"'(?:[^'\\]|\\.|'')*'"

# Where a message lists its items, with their own and their parent's number, and the
# marker of an item without a parent, the item that is meant when none is named.
ITEMS, ITEM, PARENT, ROOT_MARKER, FIRST_ITEM = "$.*.IDOC.E1EDP01", "POSEX", "UEPOS", "000000", "000010"


def _text(x: str) -> str:
    return f"coalesce(CAST({x} AS STRING), '')"


def _substring(x: str, start: str, stop: str) -> str:
    """From `start` up to `stop`, from 0; to the end where `stop` is less. Outside of the text it fails: the cast does."""
    size = f"char_length({_text(x)})"
    need = f"IF(({stop}) < ({start}), ({start}), ({stop}))"
    first = f"CAST(IF({size} < {need}, 'outside of the text', CAST(({start}) + 1 AS STRING)) AS INT)"
    return f"substring({_text(x)}, {first}, IF(({stop}) < ({start}), {size}, ({stop}) - ({start})))"


def _not(x: str) -> str:
    return f"({x} = '')" if re.fullmatch(r"\s*__p\d+\s*", x) else f"(NOT ({x}))"


#: The helpers, by name and number of arguments (None: any); each gets its arguments as SQL.
HELPERS: dict[str, tuple[int | None, Callable[..., str]]] = {
    "toUpper": (1, lambda x: f"upper({_text(x)})"),
    "toLower": (1, lambda x: f"lower({_text(x)})"),
    "trim": (1, lambda x: f"btrim({_text(x)}, '{''.join(f'\\u{ord(c):04x}' for c in BLANKS)}')"),
    "concat": (None, lambda *xs: f"concat({', '.join(map(_text, xs))})"),
    "join": (None, lambda sep, *xs: f"concat_ws({', '.join([_text(sep), *map(_text, xs)])})"),
    "matches": (2, lambda x, pattern: f"({_text(x)} RLIKE concat('^(?:', {pattern}, ')$'))"),
    "subString": (3, _substring),
    "round": (1, lambda x: f"CAST(floor(coalesce(TRY_CAST({x} AS DOUBLE), 0D) + 0.5D) AS BIGINT)"),
    "now": (0, lambda: "unix_millis(current_timestamp())"),
    "not": (1, _not),
}
TOKEN = re.compile(rf"{QUOTED}|[A-Za-z_]\w*|\s+|&&|\|\||.", re.S)


def expanded(text: str, top_item: Callable[[str], str]) -> str:
    """A value's expression with its helpers, and `if c then a else b`, as Spark SQL.

    Paths must be names already. `top_item` gives the SQL for the helper topHli. Inside a
    condition && and || mean AND and OR, and a bare text is true when it isn't empty.
    """
    tokens = TOKEN.findall(text)
    words = {t.lower() for t in tokens}
    branches = "then" in words and "case" not in words
    out, _ = _arguments(tokens, 0, branches, False, top_item)
    return ", ".join(out)


def _arguments(tokens: list[str], at: int, branches: bool, logic: bool, top_item: Callable[[str], str]) -> tuple[list[str], int]:
    """The arguments up to a closing parenthesis or the end, and the place behind it. With `logic`
    they are part of a condition."""
    args: list[str] = []
    out: list[str] = []
    last = "("  # the token before, without blanks
    conditions = ends = 0

    def done() -> None:
        args.append("".join(out) + " END" * ends)

    while at < len(tokens):
        t, low = tokens[at], tokens[at].lower()
        ahead = at + 1
        while ahead < len(tokens) and tokens[ahead].isspace():
            ahead += 1
        called = ahead < len(tokens) and tokens[ahead] == "("
        if t == ")":
            done()
            return args, at + 1
        if t == ",":
            done()
            out, conditions, ends = [], 0, 0
            at += 1
        elif t == "(":
            grouped = last in ("(", "&&", "||") or last.lower() == "if"
            inner, at = _arguments(tokens, at + 1, branches, grouped and (logic or conditions > 0), top_item)
            out.append(f"({', '.join(inner)})")
        elif branches and low == "if":
            out.append("CASE WHEN ")
            conditions += 1
            ends += 1
            at += 1
        elif branches and low == "then" and conditions:
            out.append("THEN")
            conditions -= 1
            at += 1
        elif t in ("&&", "||") and (logic or conditions):
            out.append(" AND " if t == "&&" else " OR ")
            at += 1
        elif re.fullmatch(r"__p\d+", t) and (logic or conditions) and (last in ("(", "&&", "||") or last.lower() == "if") and (
            ahead >= len(tokens) or tokens[ahead] in ("&&", "||", ")") or tokens[ahead].lower() == "then"
        ):
            out.append(f"({t} <> '')")  # a text as a condition
            at += 1
        elif called and (t == "topHli" or t in HELPERS):
            inner, behind = _arguments(tokens, ahead + 1, branches, False, top_item)
            inner = [] if inner == [""] else [x.strip() for x in inner]
            count, made = (1, top_item) if t == "topHli" else HELPERS[t]
            same = count is None or count == len(inner)  # round(x, 2) is Spark's own
            out.append(made(*inner) if same else f"{t}({', '.join(inner)})")
            at = behind
        else:
            out.append(t)
            at += 1
        if not t.isspace():
            last = t
    done()
    return args, at


@dataclass(frozen=True)
class Value:
    """SQL for a value and, where it can fail, for whether it does."""

    sql: str
    failed: str | None = None


def tried(sql: str) -> str:
    return re.sub(rf"{QUOTED}|`[^`]*`|(?<![\w.])CAST\(", lambda m: "TRY_CAST(" if m.group(0) == "CAST(" else m.group(0), sql)


def analysed(spark: SparkSession, text: str, columns: dict[str, str]) -> Value:
    """The expression over columns of these types with its casts tried, and when one fails.

    Expressions with lambdas keep their text: their casts are tried where they are written out,
    and what fails in them is null.
    """
    if "->" in re.sub(QUOTED, "", text):
        return Value(re.sub(rf"{QUOTED}|(?<![\w.])[Cc][Aa][Ss][Tt]\s*\(", lambda m: m.group(0) if m.group(0)[0] == "'" else "TRY_CAST(", text))
    schema = ", ".join(f"`{n}` {t}" for n, t in columns.items()) or "__none string"
    with settings(spark, {"spark.sql.ansi.enabled": "true"}):
        empty = spark.createDataFrame([], schema)
        plan = empty.select(F.expr(text).alias("__value"))._jdf.queryExecution().analyzed()
    tree = plan.projectList().apply(0).child()
    found = list(dict.fromkeys(risks(spark, tree)))
    return Value(tried(tree.sql()), " OR ".join(f"coalesce({x}, false)" for x in found) or None)


TRIES = {"Add": "try_add", "Subtract": "try_subtract", "Multiply": "try_multiply"}
DIVISIONS = ("Divide", "IntegralDivide", "Remainder", "Pmod")


def risks(spark: SparkSession, node: JavaObject) -> Iterator[str]:
    """Conditions under which a part of an analysed expression that is reached fails."""
    kind = node.getClass().getSimpleName()
    kids = [node.children().apply(i) for i in range(node.children().size())]
    sql = [tried(k.sql()) for k in kids]
    if kind in ("CaseWhen", "If"):
        last = len(kids) % 2
        before: list[str] = []
        for i in range(0, len(kids) - last, 2):
            here = [f"NOT coalesce({c}, false)" for c in before]
            yield from _guarded(risks(spark, kids[i]), here)
            yield from _guarded(risks(spark, kids[i + 1]), [*here, f"coalesce({sql[i]}, false)"])
            before.append(sql[i])
        if last:
            yield from _guarded(risks(spark, kids[-1]), [f"NOT coalesce({c}, false)" for c in before])
        return
    for i, k in enumerate(kids):
        reached = [f"coalesce({', '.join(sql[:i])}) IS NULL"] if kind == "Coalesce" and i else []
        yield from _guarded(risks(spark, k), reached)
    if kind == "Cast" and str(node.evalMode()) != "TRY":
        given, wanted = kids[0].dataType(), node.dataType()
        if not spark._jvm.org.apache.spark.sql.catalyst.expressions.Cast.canUpCast(given, wanted):
            missing = f" AND btrim({sql[0]}) <> ''" if given.sql() == "STRING" else ""  # an empty text is a missing value
            yield f"({sql[0]} IS NOT NULL{missing} AND TRY_CAST({sql[0]} AS {wanted.sql()}) IS NULL)"
    elif kind in TRIES and node.dataType().typeName() in ("byte", "short", "integer", "long") or kind in TRIES and node.dataType().typeName().startswith("decimal"):
        yield f"({sql[0]} IS NOT NULL AND {sql[1]} IS NOT NULL AND {TRIES[kind]}({sql[0]}, {sql[1]}) IS NULL)"
    elif kind in DIVISIONS:
        yield f"({sql[0]} IS NOT NULL AND {sql[1]} = 0)"


def _guarded(found: Iterator[str], reached: list[str]) -> Iterator[str]:
    for x in found:
        yield f"({' AND '.join([*reached, x])})" if reached else x


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that hold while expressions are analysed, and are put back then."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def without_errors(spark: SparkSession) -> Iterator[None]:
    """Expressions analysed meanwhile give null where they would stop the job: overflows, division
    by zero, places outside of a list. Casts are explicit by then, so types come out the same."""
    with settings(spark, {"spark.sql.ansi.enabled": "false", "spark.sql.legacy.sizeOfNull": "false"}):
        yield


def with_failures(df: DataFrame, failed: list[str], out: str) -> DataFrame:
    """`df` with the names of the values that fail in each row: a list, empty where none does."""
    every = failed[0] if len(failed) == 1 else f"concat({', '.join(failed)})"
    return df.withColumn(out, F.expr(every) if failed else F.array().cast("array<string>"))
