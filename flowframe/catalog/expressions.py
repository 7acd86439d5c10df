"""Queries of mapping expressions and of paths into JSON."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.catalog.mapping import order_documents
from flowframe.functions import jsonpath as jp
from flowframe.functions import mapexpr as me


def parts(spark, data):
    """Part names, some missing, with padding."""
    name = F.expr("CASE p_type WHEN 'ECONOMY' THEN NULL ELSE concat('\t ', p_name, ' ') END AS name")
    return table(spark, data, "part").select("p_partkey", name, "p_brand", "p_size")


NAME = "(CASE p_type WHEN 'ECONOMY' THEN NULL ELSE chr(9) || ' ' || p_name || ' ' END)"


@query("mapexpr_to_upper", f"SELECT p_partkey, upper(coalesce({NAME}, '')) AS x FROM part")
def to_upper(spark, data):
    return parts(spark, data).select("p_partkey", me.to_upper(F.col("name")).alias("x"))


@query("mapexpr_to_lower", "SELECT p_partkey, lower(p_brand) AS x FROM part")
def to_lower(spark, data):
    return parts(spark, data).select("p_partkey", me.to_lower(F.col("p_brand")).alias("x"))


@query("mapexpr_trim", f"SELECT p_partkey, trim(coalesce({NAME}, ''), ' ' || chr(9)) AS x FROM part")
def trim(spark, data):
    return parts(spark, data).select("p_partkey", me.trim(F.col("name")).alias("x"))


@query("mapexpr_concat", f"SELECT p_partkey, coalesce({NAME}, '') || p_brand AS x FROM part")
def concat(spark, data):
    return parts(spark, data).select("p_partkey", me.concat(F.col("name"), F.col("p_brand")).alias("x"))


@query("mapexpr_join", f"SELECT p_partkey, p_brand || '-' || coalesce({NAME}, '') || '-' || p_size AS x FROM part")
def join(spark, data):
    x = me.join("-", F.col("p_brand"), F.col("name"), F.col("p_size"))
    return parts(spark, data).select("p_partkey", x.alias("x"))


@query("mapexpr_matches", "SELECT p_partkey, regexp_full_match(p_brand, 'Brand#[12]|Brand#1.') AS x FROM part")
def matches(spark, data):
    return parts(spark, data).select("p_partkey", me.matches(F.col("p_brand"), "Brand#[12]|Brand#1.").alias("x"))


@query(
    "mapexpr_substring",
    """SELECT p_partkey, CASE WHEN length(p_brand) >= 8 THEN substr(p_brand, 7, 2) END AS x,
       substr(p_brand, 7) AS y FROM part""",
)
def substring(spark, data):
    """A range beyond the text has no value."""
    brand = F.col("p_brand")
    return parts(spark, data).select(
        "p_partkey", me.substring(brand, 6, 8).alias("x"), me.substring(brand, 6, 0).alias("y")
    )


@query(
    "mapexpr_arithmetic",
    """SELECT p_partkey, p_size + 2 AS plus, p_size - 7 AS minus, p_size * 3 AS times, p_size // 4 AS quotient,
         p_size % 4 AS rest, 1::BIGINT AS text_one, CAST(p_size + 0.5 AS DOUBLE) AS half FROM (SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part)""",
)
def arithmetic(spark, data):
    size = F.col("p_size").cast("string")
    two, seven, three, four = (F.lit(n) for n in (2, 7, 3, 4))
    return parts(spark, data).select(
        "p_partkey",
        me.plus(size, two).alias("plus"),
        me.minus(size, seven).alias("minus"),
        me.times(size, three).alias("times"),
        me.divide(size, four).alias("quotient"),
        me.modulo(size, four).alias("rest"),
        me.plus(F.concat(size, F.lit(".5")), F.lit(1)).alias("text_one"),
        me.plus(size, F.lit(0.5), double=True).alias("half"),
    )


@query("mapexpr_round", "SELECT l_orderkey, CAST(floor(0.5 - l_quantity / 2) AS BIGINT) AS x FROM lineitem")
def round_(spark, data):
    """Halves go up, also below zero."""
    half = F.lit(0.0) - F.col("l_quantity") / 2
    return table(spark, data, "lineitem").select("l_orderkey", me.round_half_up(half).alias("x"))


@query(
    "mapexpr_compare",
    f"""SELECT p_partkey, CAST(p_size AS VARCHAR) < '3' AS less, coalesce({NAME}, '') == '' AS empty,
         p_brand != 'Brand#2' AS other, CAST(p_size AS VARCHAR) >= '20' AS big FROM part""",
)
def compare(spark, data):
    c = F.col
    return parts(spark, data).select(
        "p_partkey",
        me.compare(c("p_size"), "<", F.lit("3")).alias("less"),
        me.compare(c("name"), "==", F.lit("")).alias("empty"),
        me.compare(c("p_brand"), "!=", F.lit("Brand#2")).alias("other"),
        me.compare(c("p_size"), ">=", F.lit(20)).alias("big"),
    )


@query(
    "mapexpr_logic",
    f"""SELECT p_partkey, NOT (coalesce({NAME}, '') <> '') AS none, p_size <> 7 AND p_brand <> '' AS both_,
         p_size = 7 OR {NAME} IS NOT NULL AS either_ FROM part""",
)
def logic(spark, data):
    named = me.truthy(F.col("name"))
    seven = me.truthy(F.col("p_size") - 7, "number")
    return parts(spark, data).select(
        "p_partkey",
        me.negate(named).alias("none"),
        me.both(seven, me.truthy(F.col("p_brand"))).alias("both_"),
        me.either(me.negate(seven), named).alias("either_"),
    )


@query(
    "mapexpr_if",
    "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'XL' WHEN p_size > 20 THEN 'L' ELSE 'S' END AS x FROM part",
)
def choose(spark, data):
    size = F.col("p_size")
    nested = me.choose(size > 20, F.lit("L"), F.lit("S"))
    return parts(spark, data).select("p_partkey", me.choose(size > 40, F.lit("XL"), nested).alias("x"))


@query("mapexpr_now", "SELECT count(*) AS n, 1::BIGINT AS instants FROM part")
def now(spark, data):
    """One instant for the whole query."""
    df = parts(spark, data).select(me.now().alias("now"))
    return df.agg(F.count("*").alias("n"), F.count_distinct("now").alias("instants"))


@query("mapexpr_context", "SELECT p_brand, 'unbound' AS x FROM part")
def context(spark, data):
    df = parts(spark, data)
    return df.select(me.context("p_brand", df.columns), me.context("unbound", df.columns).alias("x"))


@query(
    "mapexpr_top_item",
    """WITH RECURSIVE n AS (SELECT DISTINCT l_orderkey, l_linenumber AS item, l_linenumber // 2 AS parent FROM lineitem),
       walk AS (SELECT l_orderkey, item, item AS root FROM n WHERE parent = 0
         UNION ALL SELECT n.l_orderkey, n.item, walk.root FROM n JOIN walk ON n.l_orderkey = walk.l_orderkey AND n.parent = walk.item
           WHERE n.parent <> 0)
       SELECT l_orderkey, n.item, coalesce(CAST(walk.root AS VARCHAR), 'n/a') AS root FROM n LEFT JOIN walk USING (l_orderkey, item)""",
)
def top_item(spark, data):
    """Each line of an order follows the pointers inside its own document."""
    pair = F.struct(F.col("l_linenumber").alias("item"), F.expr("l_linenumber div 2").alias("parent"))
    docs = table(spark, data, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(pair)).alias("items"))
    lines = docs.select("l_orderkey", "items", F.explode("items.item").alias("item"))
    root = me.top_item(F.col("items"), "item", "parent", F.col("item"), "0")
    return lines.select("l_orderkey", "item", root.alias("root"))


# --- paths ----------------------------------------------------------------------------

# the lines of each order in the order of the document
LINES = """(SELECT o_orderkey AS id, o_orderpriority AS priority, l_linenumber AS n, l_partkey AS part, l_returnflag AS flag,
  l_linestatus AS status, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) - 1 AS i,
  count(*) OVER (PARTITION BY o_orderkey) AS size FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def documents(spark, data):
    return order_documents(spark, data).select(F.try_parse_json("value").alias("doc"))


def doc_id():
    return jp.path(F.col("doc")).field("id").first().cast("bigint").alias("id")


@query("jsonpath_field", "SELECT o_orderkey AS id, o_orderpriority AS x, NULL::VARCHAR AS missing FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def field(spark, data):
    doc = jp.path(F.col("doc"))
    return documents(spark, data).select(
        doc_id(), doc.field("priority").first().alias("x"), doc.field("nothing").field("deeper").first().alias("missing")
    )


@query(
    "jsonpath_index",
    f"""SELECT id, max(part) FILTER (i = 0)::VARCHAR AS first, max(part) FILTER (i = size - 1)::VARCHAR AS last,
         coalesce(max(n) FILTER (i = 1)::VARCHAR, '') || max(n) FILTER (i = 0)::VARCHAR AS pair FROM {LINES} GROUP BY id""",
)
def index(spark, data):
    lines = jp.path(F.col("doc")).field("lines")
    return documents(spark, data).select(
        doc_id(),
        lines.index(0).field("part").first().alias("first"),
        lines.index(-1).field("part").first().alias("last"),
        lines.index(1, 0).field("n").joined().alias("pair"),
    )


@query(
    "jsonpath_slice",
    f"""SELECT id, coalesce(string_agg(n, ',' ORDER BY i) FILTER (i >= 1 AND i < 3), '') AS middle,
         string_agg(n, ',' ORDER BY i) FILTER (i % 2 = 0) AS even, string_agg(n, ',' ORDER BY i DESC) AS backwards,
         string_agg(n, ',' ORDER BY i) FILTER (i >= greatest(size - 2, 0)) AS tail FROM {LINES} GROUP BY id""",
)
def slice_(spark, data):
    lines = jp.path(F.col("doc")).field("lines")
    return documents(spark, data).select(
        doc_id(),
        lines.slice(1, 3).field("n").joined(",").alias("middle"),
        lines.slice(step=2).field("n").joined(",").alias("even"),
        lines.slice(step=-1).field("n").joined(",").alias("backwards"),
        lines.slice(-2).field("n").joined(",").alias("tail"),
    )


@query(
    "jsonpath_wildcard",
    f"""SELECT id, string_agg(part, '' ORDER BY i) AS parts, string_agg(flag || status, '' ORDER BY i) AS codes,
         string_agg(part || '/' || n, '/' ORDER BY i) AS named FROM {LINES} GROUP BY id""",
)
def wildcard(spark, data):
    lines = jp.path(F.col("doc")).field("lines").each()
    return documents(spark, data).select(
        doc_id(),
        lines.field("part").joined().alias("parts"),
        lines.field("codes").any_field().joined().alias("codes"),
        lines.fields("part", "n").joined("/").alias("named"),
    )


@query(
    "jsonpath_filter",
    f"""SELECT id, coalesce(string_agg(n, ',' ORDER BY i) FILTER (flag = 'R' AND part >= 100), '') AS returned,
         count(*) AS with_codes, 0::INTEGER AS mistyped FROM {LINES} GROUP BY id""",
)
def filter_(spark, data):
    """Comparisons are typed: a number is never equal to a text."""
    lines = jp.path(F.col("doc")).field("lines")
    hit = lines.where(
        lambda x: jp.same_text(jp.field_of(x, "codes"), "flag", "R") & (jp.number_of(x, "part") >= 100)
    )
    return documents(spark, data).select(
        doc_id(),
        hit.field("n").joined(",").alias("returned"),
        lines.where(lambda x: jp.has(x, "codes")).count().cast("bigint").alias("with_codes"),
        lines.where(lambda x: jp.same_text(x, "n", "1")).count().alias("mistyped"),
    )


@query(
    "jsonpath_recursive",
    f"""SELECT id, string_agg(flag, '' ORDER BY i) AS flags, 4 + 5 * count(*) AS everything,
         count(*) FILTER (flag = 'R') AS returned FROM {LINES} GROUP BY id""",
)
def recursive(spark, data):
    doc = jp.path(F.col("doc"))
    return documents(spark, data).select(
        doc_id(),
        doc.deep_field("flag").joined().alias("flags"),
        doc.deep_any().count().cast("bigint").alias("everything"),
        doc.deep_where(lambda x: jp.same_text(x, "flag", "R")).count().cast("bigint").alias("returned"),
    )


@query("jsonpath_parent", f"SELECT id || '-' || n AS row_key, priority FROM {LINES}")
def parent(spark, data):
    """Values of the enclosing document, carried along when its elements become rows."""
    lines = jp.path(F.col("doc")).field("lines").each()
    df = documents(spark, data).select("doc", F.explode(lines.values).alias("line"))
    key = F.concat_ws("-", jp.field_text(F.col("doc"), "id"), jp.field_text(F.col("line"), "n"))
    return df.select(key.alias("row_key"), jp.field_text(F.col("doc"), "priority").alias("priority"))
