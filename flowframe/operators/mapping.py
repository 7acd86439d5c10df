"""Map JSON documents to keyed wide rows.

A mapping names source maps (which documents, which templates) and templates (table, row key,
cells, children). The whole mapping becomes one array-of-rows expression over the document,
which is parsed once; a single explode turns it into rows. There is no shuffle, whatever the
number of templates or the depth of children.

Values are texts of three kinds:

* a path such as `$.data.vendor`, `../$.header.id` or `../../$.id` (the parent's and the
  grandparent's document): the value of its first match, null when missing;
* a literal in quotes;
* any Spark SQL expression, in which a path stands for the texts of all its matches in one text,
  empty when missing. The helpers toUpper, toLower, trim, concat, join, matches, subString, round,
  now, not and topHli and the form `if c then a else b` may be used in it.

Paths may hold names, indexes and lists of them, slices, `*`, filters `[?(@.a == 'x')]` and
descents `..name`. A value that fails (text that is no number where one is asked for, an overflow,
a division by zero, a part outside of a text) rejects its message: the others go on. A missing or
empty text is no failure; what is computed from it is null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.functions.jsonpath import OPENING, step
from flowframe.operators import mapvalues
from flowframe.operators.mapvalues import QUOTED, Value

SIMPLE = r"(?:\.\./){0,2}\$(?:\.[A-Za-z_][\w-]*|\[\d+\]|\['[^']*'\])*"
STEP = (
    r"(?:\.\.?(?:[A-Za-z_][\w-]*|\*)|\[\s*(?:-?\d+(?:\s*,\s*-?\d+)*|'[^']*'(?:\s*,\s*'[^']*')*|\*"
    r"|-?\d*:-?\d*(?::-?\d+)?|\?\((?:[^()']|'[^']*')*\))\s*\])"
)
PATH = rf"(?:\.\./){{0,2}}\${STEP}*"
ROW_TYPE = (
    "struct<table_name:string,row_key:string,family:string,cells:map<string,string>,"
    "namespace:string,dedup_key:string,sort_key:string>"
)


#: In SQL, a child's document while its texts are read.
ITEM = "__item"


@dataclass(frozen=True)
class MappedFrames:
    rows: DataFrame
    doc_ids: DataFrame
    rejects: DataFrame


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def version_of(spec: dict) -> tuple[int, ...]:
    return tuple(int(p) for p in re.findall(r"\d+", str(spec.get("version", "0.4"))))


@dataclass(frozen=True)
class Scope:
    """The documents a value can reach: the current one first, then its parents.

    Texts of the message itself are read once each, into columns listed in `columns`; they
    are used by cells, keys and hashes alike. Those of a child's document are read once into the
    fields of a struct, which `texts` lists for each document below the message. `failures` gathers SQL for the names of values that
    fail, as lists; `known` keeps what was analysed. With `bad_as_null` a failing value is null.
    """

    spark: SparkSession
    docs: tuple[str, ...] = ("doc",)
    columns: dict[str, str] = field(default_factory=dict)
    failures: list[str] = field(default_factory=list)
    known: dict[tuple[str, int], Value] = field(default_factory=dict)
    bad_as_null: bool = False
    texts: tuple[dict[str, str], ...] = ()

    def child(self, name: str) -> Scope:
        return Scope(self.spark, (name, *self.docs), self.columns, [], {}, self.bad_as_null, ({}, *self.texts))

    def fresh(self) -> Scope:
        return Scope(self.spark, self.docs, self.columns, [], self.known, self.bad_as_null, self.texts)

    def own(self) -> str:
        """SQL for the current document."""
        return f"{self.docs[0]}.doc" if self.texts else self.docs[0]

    def bound(self, each: str) -> str:
        """A list of children's documents as structs of each document and the texts read in it."""
        fields = [f"'{name}', {found}" for found, name in self.texts[0].items()]
        return f"transform({each}, {ITEM} -> named_struct({', '.join([f"'doc', {ITEM}", *fields])}))"

    def failing(self) -> str:
        """SQL for the names of the values that fail, so far."""
        found = list(dict.fromkeys(self.failures))
        return found[0] if len(found) == 1 else f"concat({', '.join(found)})" if found else NO_NAMES

    def value(self, text: str, name: str) -> str:
        """SQL for an expression; where it can fail, `name` is noted."""
        key = (text, len(self.docs))
        if key not in self.known:
            self.known[key] = evaluated(text, self)
        made = self.known[key]
        if made.failed and self.bad_as_null:
            return f"IF({made.failed}, NULL, {made.sql})"
        if made.failed:
            self.failures.append(f"IF({made.failed}, array({sql_text(name)}), {NO_NAMES})")
        return made.sql

    def text_at(self, path: str) -> str:
        """SQL for the text at a path."""
        return self.reach(path, f"try_variant_get({{doc}}, {sql_text(path.replace('../', ''))}, 'string')")

    def reach(self, path: str, found: str) -> str:
        """What stands for `found` with the document that the path starts in: a column, or a child's field."""
        ups = path.count("../")
        if ups >= len(self.docs):
            raise ValueError(f"path {path!r} reaches above the document")
        if ups == len(self.texts):
            return self.columns.setdefault(found.replace("{doc}", "doc"), f"__text{len(self.columns)}")
        kept = self.texts[ups]
        return f"{self.docs[ups]}.{kept.setdefault(found.replace('{doc}', ITEM), f't{len(kept)}')}"

    def first_text(self, path: str) -> str:
        """SQL for the text of the first match."""
        if re.fullmatch(SIMPLE, path):
            return self.text_at(path)
        return self.reach(path, f"try_variant_get(try_element_at({matches_sql(path, '{doc}')}, 1), '$', 'string')")

    def all_texts(self, path: str) -> str:
        """SQL for the texts of all matches in one text; empty without one."""
        if re.fullmatch(SIMPLE, path):
            return f"coalesce({self.text_at(path)}, '')"
        every = f"transform({matches_sql(path, '{doc}')}, m -> try_variant_get(m, '$', 'string'))"
        return f"coalesce({self.reach(path, f"array_join({every}, '')")}, '')"


NO_MATCH = "CAST(array() AS array<variant>)"
NO_NAMES = "CAST(array() AS array<string>)"


def _get(v: str, at: str, kind: str) -> str:
    return f"try_variant_get({v}, {sql_text(at)}, '{kind}')"


def _field(v: str, name: str, at: str = "$") -> str:
    return _get(v, at + step(name)[1:], "variant")


def _elements(v: str, at: str = "$") -> str:
    return f"coalesce({_get(v, at, 'array<variant>')}, {NO_MATCH})"


def _members(v: str, at: str = "$") -> str:
    return f"coalesce(map_values({_get(v, at, 'map<string,variant>')}), {NO_MATCH})"


def one_list(lists: list[str]) -> str:
    """The items of several lists, none of them null. (`concat` evaluates lists many times slower.)"""
    return lists[0] if len(lists) == 1 else f"flatten(array({', '.join(lists)}))"


def _some(values: list[str]) -> str:
    return f"filter(array({', '.join(values)}), z -> z IS NOT NULL)"


def _slice(items: str, low: str, high: str, by: str) -> str:
    """Bounds below zero count from the end; a negative step walks from the end, with mirrored bounds."""
    stride = int(by or 1)
    walked = f"reverse({items})" if stride < 0 else items

    def bound(text: str, default: str) -> str:
        if not text:
            return default
        x = int(text) if stride > 0 else -1 - int(text)
        return str(x) if x >= 0 else f"greatest(size({items}) - {-x}, 0)"

    first, last = bound(low, "0"), bound(high, f"size({items})")
    cut = f"slice({walked}, {first} + 1, greatest({last} - {first}, 0))"
    return cut if abs(stride) == 1 else f"filter({cut}, (z, zi) -> zi % {abs(stride)} = 0)"


COMPARED = re.compile(r"@((?:\.[A-Za-z_][\w-]*|\['[^']*'\])*)\s*(==|!=|<=|>=|<|>)\s*('[^']*'|-?\d+(?:\.\d+)?|true|false)|@((?:\.[A-Za-z_][\w-]*|\['[^']*'\])+)")


def filter_sql(text: str, v: str) -> str:
    """A filter's condition on a value: typed comparisons and existence, with &&, || and !."""

    def one(m: re.Match) -> str:
        if m.group(4):
            return f"(try_variant_get({v}, {sql_text('$' + m.group(4))}, 'variant') IS NOT NULL)"
        at, op, given = sql_text("$" + m.group(1)), m.group(2), m.group(3)
        kind = f"schema_of_variant(try_variant_get({v}, {at}, 'variant'))"
        sign = {"==": "=", "!=": "<>"}.get(op, op)
        if given[0] == "'":
            return f"({kind} = 'STRING' AND try_variant_get({v}, {at}, 'string') {sign} {given})"
        if given in ("true", "false"):
            return f"({kind} = 'BOOLEAN' AND try_variant_get({v}, {at}, 'boolean') {sign} {given})"
        return f"({kind} RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)' AND try_variant_get({v}, {at}, 'double') {sign} {given})"

    out = COMPARED.sub(one, text).replace("&&", " AND ").replace("||", " OR ")
    return re.sub(r"!(?!=)", " NOT ", out)


def _descent(v: str, name: str) -> str:
    """Values of a name (or of any) at every depth, level by level, as deep as the document is.

    A node's fields are read once; there are no more levels than brackets that open in its JSON text.
    """
    levels = f"regexp_count(coalesce(to_json({v}), '[]'), {sql_text(OPENING)})"
    if name == "*":
        hit, inside = _members("f"), one_list([_elements("f"), _members("f")])
    else:
        others = f"map_values(map_filter(try_variant_get(f, '$', 'map<string,variant>'), (k, x) -> k <> {sql_text(name)}))"
        hit, inside = _some([_field("f", name)]), f"coalesce({others}, {_elements('f')})"
    start = f"named_struct('frontier', array({v}), 'found', CAST(array() AS array<array<variant>>))"
    nodes = f"transform(w.frontier, f -> named_struct('inside', {inside}, 'hit', {hit}))"
    walked = f"transform(array({nodes}), p -> named_struct('frontier', flatten(p.inside), 'found', array_append(w.found, flatten(p.hit))))"
    down = f"IF(size(w.frontier) > 0, element_at({walked}, 1), w)"
    return f"reduce(array_repeat(0, {levels}), {start}, (w, wi) -> {down}, w -> flatten(w.found))"


def matches_sql(path: str, doc: str) -> str:
    """SQL for the list of values that a path matches in a document.

    Plain fields are part of the path that the next step reads, as each value that is taken out is a copy.
    """
    node, at = _some([doc]), "$"

    def down(v: str) -> str:
        return node if at == "$" else f"flatten(transform({node}, {v} -> {_some([_get(v, at, 'variant')])}))"

    for n, found in enumerate(re.findall(STEP, path.replace("../", ""))):
        v, inner = f"v{n}", found[1:-1].strip() if found[0] == "[" else ""
        plain = re.fullmatch(r"\.([^.*].*)|\[\s*'([^']*)'\s*\]", found)
        if plain:
            at += step(plain.group(1) or plain.group(2) or "")[1:]
            continue
        if found.startswith(".."):
            node, at = down(f"w{n}"), "$"
            expand = _descent(v, found[2:])
        elif found in (".*",):
            expand = _members(v, at)
        elif inner == "*":
            expand = one_list([_elements(v, at), _members(v, at)])
        elif inner[0] == "'":
            expand = _some([_field(v, name, at) for name in re.findall(r"'([^']*)'", inner)])
        elif inner[0] == "?":
            one = f"IF({_get(v, at, 'map<string,variant>')} IS NOT NULL, array({_get(v, at, 'variant')}), {NO_MATCH})"
            items = f"coalesce({_get(v, at, 'array<variant>')}, {one})"
            expand = f"filter({items}, q{n} -> coalesce({filter_sql(inner[2:-1], f'q{n}')}, false))"
        elif ":" in inner:
            low, high, *by = inner.split(":")
            expand = _slice(_elements(v, at), low, high, by[0] if by else "")
        else:
            places = [int(x) for x in inner.split(",")]
            expand = _some([f"try_element_at({_elements(v, at)}, {x + 1 if x >= 0 else x})" for x in places])
        node, at = f"flatten(transform({node}, {v} -> {expand}))", "$"
    return down("w")


def value_sql(text: str, scope: Scope, name: str = "") -> str:
    """SQL for a mapping value, as text or null; where it fails, it is noted under the name or its own text."""
    if re.fullmatch(PATH, text.strip()):
        return scope.first_text(text.strip())
    return f"TRY_CAST({scope.value(text, name or text)} AS STRING)"


def evaluated(text: str, scope: Scope) -> Value:
    """A Spark SQL expression with its paths replaced by their texts, and when it fails.

    Of a path that is compared with a number the text counts as one where it is one.
    """
    number = rf"(?P<path>{PATH})(?P<op>\s*(?:==|=|!=|<>|<=|>=|<|>)\s*)(?P<n>-?\d+(?:\.\d+)?)\b"
    pieces, at = [], 0
    for m in re.finditer(rf"{QUOTED}|{number}", text):
        if m.group("path"):
            pieces += [text[at : m.start()], f"TRY_CAST({m.group('path')} AS DOUBLE){m.group('op')}{m.group('n')}"]
            at = m.end()
    given: dict[str, str] = {}  # SQL of a text: the name that stands for it meanwhile

    def named(sql: str) -> str:
        return given.setdefault(sql, f"__p{len(given)}")

    def swap(m: re.Match) -> str:
        return m.group(0) if m.group(0)[0] == "'" else named(scope.all_texts(m.group(0)))

    spelled = re.sub(rf"{QUOTED}|{PATH}", swap, "".join(pieces) + text[at:])
    back = lambda sql: re.sub(rf"{QUOTED}|__p\d+", lambda m: names.get(m.group(0), m.group(0)), sql)
    names: dict[str, str] = {}

    def top_item(x: str) -> str:
        names.update({v: k for k, v in given.items()})
        return named(top_item_sql(back(x), scope))

    spelled = mapvalues.expanded(spelled, top_item)
    names.update({v: k for k, v in given.items()})
    columns = {"topic": "string", "value": "string", **dict.fromkeys(names, "string")}
    made = mapvalues.analysed(scope.spark, spelled, columns)
    return Value(back(made.sql), made.failed and back(made.failed))


def top_item_sql(x: str, scope: Scope) -> str:
    """SQL for the item at the top of item `x` of a message: parents are followed until none is named."""
    items = scope.reach("../" * (len(scope.docs) - 1) + "$", matches_sql(mapvalues.ITEMS + "[*]", "{doc}"))
    whole = f"IF(size({items}) = 0, {scope.reach('../' * (len(scope.docs) - 1) + '$', matches_sql(mapvalues.ITEMS, '{doc}'))}, {items})"
    field_of = lambda v, name: f"try_variant_get({v}, '$.{name}', 'string')"
    up = f"array_join(transform(filter({whole}, i -> {field_of('i', mapvalues.ITEM)} = a.at), i -> coalesce({field_of('i', mapvalues.PARENT)}, '')), '')"
    step = f"IF(a.done OR {up} IN ('', '{mapvalues.ROOT_MARKER}'), named_struct('at', a.at, 'done', true), named_struct('at', {up}, 'done', false))"
    start = f"named_struct('at', coalesce(nullif(CAST({x} AS STRING), ''), '{mapvalues.FIRST_ITEM}'), 'done', false)"
    return f"reduce(sequence(0, size({whole})), {start}, (a, n) -> {step}, a -> IF(a.done, a.at, 'cycle'))"


def condition_sql(text: str, scope: Scope) -> str:
    """A routing condition; `&&` and `||` may stand for AND and OR."""
    words = {"&&": " AND ", "||": " OR "}
    spelled = re.sub(rf"{QUOTED}|&&|\|\|", lambda m: words.get(m.group(0), m.group(0)), text)
    return f"coalesce(({scope.value(spelled, 'when')}), false)"


def key_text(parts: list[str]) -> str:
    """Parts joined by `-`, each `?` when null or empty."""
    return "concat_ws('-', " + ", ".join(f"coalesce(nullif({p}, ''), '?')" for p in parts) + ")"


def children_sql(select: str, doc: str) -> str:
    """The sub-objects a child template maps: an array's elements, or a single object."""
    if re.fullmatch(SIMPLE, select):
        at = select.replace("../", "")
        return f"coalesce({_get(doc, at, 'array<variant>')}, {_some([_get(doc, at, 'variant')])})"
    found = matches_sql(select, doc)
    return f"flatten(transform({found}, n -> coalesce(try_variant_get(n, '$', 'array<variant>'), array(n))))"


def row_spec(row: dict) -> dict:
    """A row definition in one form, whichever dialect it was written in."""
    cols = []
    for c in row.get("cols") or []:
        if isinstance(c, dict):
            cols.append(c)
        else:  # older form: [name, expression]
            cols.append({"name": c[0], "value": c[1], "isDedup": c[0] in (row.get("deDupCols") or [])})
    key = row.get("rowKey", row.get("rowkey")) or []
    return {
        "table": row.get("name", row.get("tableName", "")),
        "namespace": row.get("namespace", ""),
        "family": row.get("colFamily", row.get("col_family", "N/A")),
        "cols": cols,
        "key": [key] if isinstance(key, str) else list(key),
        # older keys are expressions; newer ones name columns first
        "key_is_expression": "rowkey" in row or isinstance(key, str),
    }


def rows_sql(row: dict, scope: Scope, sort_key: str) -> str:
    """SQL for the rows of one row definition: one per family that has a cell."""
    spec = row_spec(row)
    cells: dict[tuple[str, str], str] = {}
    marked: list[tuple[str, str]] = []
    for c in spec["cols"]:
        family, _, name = c["name"].rpartition(":")
        cell = (family or c.get("colFamily") or spec["family"], name)
        value = f"nullif({value_sql(c['value'], scope, name)}, '')"
        # of two columns with one name, the last that has a value wins
        cells[cell] = f"coalesce({value}, {cells[cell]})" if cell in cells else value
        if c.get("isDedup") and cell not in marked:
            marked.append(cell)

    def key_part(text: str) -> str:
        family, _, name = text.rpartition(":")
        cell = (family or spec["family"], name)
        if not spec["key_is_expression"] and cell in cells:
            return cells[cell]
        if re.fullmatch(r"\w+", text):
            return sql_text(text)  # an unbound name is its own text
        return value_sql(text, scope)

    row_key = key_text([key_part(k) for k in spec["key"]]) if spec["key"] else "'?'"
    dedup = "''"
    if marked:
        dedup = f"trim(leading '0' from md5({key_text([cells[m] for m in marked])}))"
    families: dict[str, list[tuple[str, str]]] = {}
    for (family, name), value in cells.items():
        families.setdefault(family, []).append((name, value))
    made = []
    for family, named in families.items():
        pairs = ", ".join(f"{sql_text(n)}, {v}" for n, v in named)
        made.append(
            f"named_struct('table_name', {sql_text(spec['table'])}, 'row_key', {row_key}, "
            f"'family', {sql_text(family)}, 'cells', map_filter(map({pairs}), (k, v) -> v IS NOT NULL), "
            f"'namespace', {sql_text(spec['namespace'])}, 'dedup_key', {dedup}, 'sort_key', {sort_key})"
        )
    if not made:
        return f"CAST(array() AS array<{ROW_TYPE}>)"
    return f"filter(array({', '.join(made)}), r -> size(r.cells) > 0)"


def template_sql(template: dict, templates: dict[str, dict], scope: Scope, sort_key: str, depth: int = 0) -> str:
    """SQL for all rows of a template: its own and, through its children, their templates'."""
    defined = template.get("row") or template.get("rows") or []
    parts = [rows_sql(r, scope, sort_key) for r in (defined if isinstance(defined, list) else [defined])]
    for child in template.get("children") or []:
        kid = f"k{depth}"
        below = scope.child(kid)
        inner = template_sql(templates[child["template"]], templates, below, sort_key, depth + 1)
        each = below.bound(children_sql(child["select"], scope.own()))
        parts.append(f"flatten(transform({each}, {kid} -> {inner}))")
        if below.failures:
            scope.failures.append(f"flatten(transform({each}, {kid} -> {below.failing()}))")
    return one_list(parts)


def source_maps(spec: dict) -> list[dict]:
    """Source maps of a mapping; a list of topics in the older dialect becomes one each."""
    if spec.get("sourceMap"):
        return spec["sourceMap"]
    topics = spec.get("topics") or spec.get("kafka-topics") or []
    return [{**t, "sourceName": t["topic"], "when": f"topic = {sql_text(t['topic'])}"} for t in topics]


def extract_topic(df: DataFrame, setting: str, value_col: str = "value", out: str = "topic") -> DataFrame:
    """The topic of each message: a literal, or the text at a JSON path.

    A message without that path has the topic `unknown`; text that is no JSON has none.
    """
    if "$" not in setting:
        return df.withColumn(out, F.lit(setting))
    doc = F.try_parse_json(F.col(value_col))
    if re.fullmatch(SIMPLE, setting):
        found = F.try_variant_get(doc, setting, "string")
    else:
        parsed = df.withColumn("__doc", doc)
        first = f"try_variant_get(try_element_at({matches_sql(setting, '__doc')}, 1), '$', 'string')"
        told = F.when(F.col("__doc").isNotNull(), F.coalesce(F.expr(first), F.lit("unknown")))
        return parsed.withColumn(out, told).drop("__doc")
    return df.withColumn(out, F.when(doc.isNotNull(), F.coalesce(found, F.lit("unknown"))))


def explode_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per JSON text of a record that may hold several, one per line."""
    lines = F.transform(F.split(F.col(value_col), "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    return df.withColumn(value_col, F.explode(F.filter(lines, lambda x: x != "")))


@dataclass(frozen=True)
class Plan:
    """The SQL of a mapping over parsed messages: their rows as one list, their document ids, and
    the names of failing values (lists)."""

    rows: str
    ids: list[str]
    failures: list[str]


NO_ROWS = f"CAST(array() AS array<struct<source_name:string,row:{ROW_TYPE}>>)"


def mapping_plan(spec: dict, scope: Scope) -> Plan:
    templates = {t["name"]: t for t in spec.get("templates") or []}
    tagged, ids, failures = [], [], []
    for m in source_maps(spec):
        when = m.get("when")
        name = sql_text(m.get("sourceName", ""))
        id_exprs = m.get("idockey") or []
        if id_exprs:
            ids.append(key_text([value_sql(e, scope) for e in id_exprs]))
        if not when:
            continue
        here, asked = scope.fresh(), scope.fresh()
        sort_exprs = m.get("sortkey") or []
        sort_key = key_text([value_sql(e, here, "sortkey") for e in sort_exprs]) if sort_exprs else "''"
        made = [template_sql(templates[t], templates, here, sort_key) for t in m.get("templates") or []]
        rows = one_list(made)
        condition = condition_sql(re.sub(r"\bsourceName\b", lambda _: name, when), asked)
        # tested here rather than in a filter, which would parse every document twice
        condition = f"doc IS NOT NULL AND {condition}"
        if asked.failures:
            failures.append(f"IF(doc IS NOT NULL, {asked.failing()}, {NO_NAMES})")
        if here.failures:
            failures.append(f"IF({condition}, {here.failing()}, {NO_NAMES})")
        tagged.append(
            f"transform(CASE WHEN {condition} THEN {rows} ELSE CAST(array() AS array<{ROW_TYPE}>) END, "
            f"x -> struct({name} AS source_name, x AS row))"
        )
    if not tagged:
        raise ValueError("the mapping has no source map with a condition")
    every = one_list(tagged)
    return Plan(every, list(dict.fromkeys(ids)) or ["'?'"], failures)


def scope_of(df: DataFrame, spec: dict) -> Scope:
    return Scope(df.sparkSession, bad_as_null=spec.get("badValues", "reject") == "null")


def map_documents(df: DataFrame, spec: dict, topic_col: str = "topic", value_col: str = "value") -> MappedFrames:
    """Apply a mapping to JSON messages.

    `rows` holds the mapped rows, `doc_ids` the distinct (topic, doc_id) of all messages, and
    `rejects` the messages that are no JSON (failed is null) and those in which a value of a
    template that applies fails (failed names the columns); they have no rows. With `badValues`
    set to `null` in the spec such messages keep their rows, and the values are null.
    """
    messages = explode_lines(df.select(F.col(topic_col).alias("topic"), F.col(value_col).alias("value")))
    parsed = messages.withColumn("doc", F.try_parse_json("value"))
    scope = scope_of(df, spec)
    plan = mapping_plan(spec, scope)
    every = plan.rows
    with mapvalues.without_errors(df.sparkSession):
        parsed = parsed.withColumns({name: F.expr(text) for text, name in scope.columns.items()})
        bad = F.col("doc").isNull()
        if plan.failures:
            parsed = mapvalues.with_failures(parsed, plan.failures, "__failed")
            every = f"CASE WHEN size(__failed) = 0 THEN {every} ELSE {NO_ROWS} END"
            bad = bad | (F.size("__failed") > 0)
        out = parsed.select("topic", F.explode(F.expr(every)).alias("m"))
        good = parsed.filter("doc IS NOT NULL")
        doc_ids = good.select("topic", F.explode(F.expr(f"array({', '.join(plan.ids)})")).alias("doc_id")).distinct()
        names = F.nullif(F.array_join(F.array_distinct("__failed"), ","), F.lit("")) if plan.failures else F.lit(None).cast("string")
        rejects = parsed.filter(bad).select("topic", "value", names.alias("failed"))
    rows = out.select("topic", "m.source_name", "m.row.*")
    return MappedFrames(rows, doc_ids, rejects)


MESSAGE, ROW, ID, REJECT = "message", "row", "id", "reject"


def map_tagged(
    df: DataFrame, spec: dict, topic: str | None = None, sort_path: str | None = None, topic_col: str = "topic", value_col: str = "value"
) -> DataFrame:
    """All that a mapping makes of messages in one frame, from one look at each.

    kind tells what a row is: `message` (each one), `row` (a mapped row, in `row`), `id` (a document
    id, in doc_id) or `reject` (its text in value, and what failed). With `topic`, a path or a literal, the topic is
    taken from the message itself, as in `extract_topic`; a message that is no JSON has none. With
    `sort_path` messages carry the whole number at that path in `order`; those without one are
    rejected (failed is `sort`), as they have no place in the order.
    """
    given = [] if topic is not None else [F.col(topic_col).alias("topic")]
    messages = explode_lines(df.select(*given, F.col(value_col).alias("value")))
    parsed = messages.withColumn("doc", F.try_parse_json("value"))
    scope = scope_of(df, spec)
    plan = mapping_plan(spec, scope)
    told = None
    if topic is not None:
        found = f"coalesce({scope.first_text(topic)}, 'unknown')" if "$" in topic else sql_text(topic)
        told = F.expr(f"IF(doc IS NULL AND {'true' if '$' in topic else 'false'}, CAST(NULL AS STRING), {found})")
    order = f"TRY_CAST({scope.first_text(sort_path)} AS BIGINT)" if sort_path else "CAST(NULL AS BIGINT)"
    with mapvalues.without_errors(df.sparkSession):
        parsed = parsed.withColumns({name: F.expr(text) for text, name in scope.columns.items()})
        if told is not None:
            parsed = parsed.withColumn("topic", told)
        parsed = mapvalues.with_failures(parsed.withColumn("order", F.expr(order)), plan.failures, "__failed")
        if sort_path:
            parsed = parsed.withColumn("__failed", F.expr(f"IF(doc IS NOT NULL AND order IS NULL, array('sort'), IF(doc IS NULL, {NO_NAMES}, __failed))"))
        none = {"value": "CAST(NULL AS STRING)", "failed": "CAST(NULL AS STRING)", "doc_id": "CAST(NULL AS STRING)", "source_name": "CAST(NULL AS STRING)", "row": f"CAST(NULL AS {ROW_TYPE})"}

        def item(kind: str, **fields: str) -> str:
            held = {**none, **fields}
            return f"named_struct('kind', '{kind}', " + ", ".join(f"'{n}', {v}" for n, v in held.items()) + ")"

        ids = f"transform(array({', '.join(plan.ids)}), d -> {item(ID, doc_id='d')})"
        rows = f"transform({plan.rows}, m -> {item(ROW, source_name='m.source_name', row='m.row')})"
        names = "nullif(array_join(array_distinct(__failed), ','), '')"
        reject = f"array({item(REJECT, value='value', failed=names)})"
        unplaced = "array_contains(__failed, 'sort')" if sort_path else "false"
        items = f"CASE WHEN doc IS NULL OR {unplaced} THEN {reject} WHEN size(__failed) > 0 THEN concat({reject}, {ids}) ELSE concat({ids}, {rows}) END"
        every = F.expr(f"concat(array({item(MESSAGE)}), {items})")
        return parsed.select("topic", "order", F.inline(every))


def split_tagged(tagged: DataFrame) -> MappedFrames:
    """The frames of `map_documents` from a tagged one; `rows` has `order` besides."""
    of = lambda kind: tagged.filter(F.col("kind") == kind)
    return MappedFrames(
        of(ROW).select("topic", "order", "source_name", "row.*"),
        of(ID).select("topic", "doc_id").distinct(),
        of(REJECT).select("topic", "value", "failed"),
    )


def parse_mapped_rows(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Already mapped rows from their JSON text."""
    return df.select(F.from_json(F.col(value_col), ROW_TYPE).alias("r")).select("r.*")


def target_tables(spec: dict) -> list[str]:
    """The tables that a mapping writes to."""
    defined = [t.get("row") or t.get("rows") or [] for t in spec.get("templates") or []]
    rows = [r for d in defined for r in (d if isinstance(d, list) else [d])]
    return list(dict.fromkeys(row_spec(r)["table"] for r in rows))


def catalog_qualifiers(spec: dict, template: str) -> dict[str, str]:
    """The cells a template can write: {qualifier: family}."""
    found: dict[str, Any] = {t["name"]: t for t in spec["templates"]}[template]
    defined = found.get("row") or found.get("rows")
    row = row_spec(defined[0] if isinstance(defined, list) else defined)
    return {
        c["name"].rpartition(":")[2]: c["name"].rpartition(":")[0] or c.get("colFamily") or row["family"]
        for c in row["cols"]
    }
