"""Queries of the mapping of JSON documents to keyed rows."""

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators import mapping as op


def messages(spark, data, *keep):
    """Events as messages; the topic is inside. Every `error` message is broken JSON."""
    header = F.struct(
        F.col("event_type").alias("category"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("timestamp"),
        F.lit("1.0").alias("version"),
    )
    body = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.lit("noted")).alias("note"),
    )
    whole = F.to_json(F.struct(header.alias("header"), body.alias("data")))
    broken = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(whole)
    return table(spark, data, "events").select(*keep, broken.alias("value"))


MESSAGES = """(SELECT event_id, event_type, CAST(event_id AS VARCHAR) AS id, 'u' || user_id AS source,
  strftime(ts, '%Y%m%d%H%M%S') AS stamp, json_extract_string(props, '$.k') AS k,
  CASE WHEN event_type = 'view' THEN '' ELSE 'noted' END AS note FROM events WHERE event_type <> 'error')"""


def template(name, table_name, cols, key, family="f", children=()):
    row = {"name": table_name, "namespace": "shop", "colFamily": family, "rowKey": key, "cols": cols}
    return {"name": name, "row": row, "children": list(children)}


COLS = [
    {"name": "source", "value": "$.header.source", "isDedup": True},
    {"name": "k", "value": "$.data.k", "isDedup": True},
    {"name": "note", "value": "$.data.note"},
    {"name": "size", "value": "CASE WHEN CAST($.data.k AS INT) >= 50 THEN 'large' ELSE 'small' END"},
    {"name": "twice", "value": "$.header.source"},
    {"name": "twice", "value": "upper($.header.category)"},
]
KEYS = {"idockey": ["$.data.id"], "sortkey": ["$.header.timestamp", "$.header.category"]}
DETAILS = {
    "version": "0.4.1",
    "templates": [template("details", "details", COLS, ["source", "k", "'one'", "$.data.missing"])],
    "sourceMap": [{"sourceName": "all", "templates": ["details"], "when": "$.header.version == '1.0'", **KEYS}],
}


def run(spark, data, spec, setting="$.header.category"):
    return op.map_documents(op.extract_topic(messages(spark, data), setting), spec)


def as_text(rows):
    return rows.withColumn("cells", F.to_json("cells"))


@query(
    "extract_topic",
    """SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS topic, count(*) AS n
       FROM events GROUP BY event_type""",
)
def extract_topic(spark, data):
    df = op.extract_topic(messages(spark, data), "$.header.category")
    return df.groupBy("topic").agg(F.count("*").alias("n"))


@query(
    "extract_topic_literal_or_unknown",
    """SELECT 'orders' AS fixed, CASE WHEN event_type = 'error' THEN NULL ELSE 'unknown' END AS found, count(*) AS n
       FROM events GROUP BY ALL""",
)
def extract_topic_literal(spark, data):
    df = op.extract_topic(messages(spark, data), "orders", out="fixed")
    return op.extract_topic(df, "$.header.nothing", out="found").groupBy("fixed", "found").agg(F.count("*").alias("n"))


@query(
    "map_columns",
    f"""SELECT id, CAST(to_json(CASE WHEN note = '' THEN map(['source', 'k', 'size', 'twice'], [source, k, size, up])
          ELSE map(['source', 'k', 'note', 'size', 'twice'], [source, k, note, size, up]) END) AS VARCHAR) AS cells
        FROM (SELECT *, CASE WHEN CAST(k AS INT) >= 50 THEN 'large' ELSE 'small' END AS size, upper(event_type) AS up
          FROM {MESSAGES})""",
)
def map_columns(spark, data):
    """Empty cells are dropped; of two columns with one name the last with a value wins."""
    spec = {**DETAILS, "templates": [template("details", "details", COLS, ["$.data.id"])]}
    return as_text(run(spark, data, spec).rows).select(F.col("row_key").alias("id"), "cells")


@query("row_key", f"SELECT source || '-' || k || '-one-?' AS row_key FROM {MESSAGES}")
def row_key(spark, data):
    return run(spark, data, DETAILS).rows.select("row_key")


@query("dedup_hash", f"SELECT ltrim(md5(source || '-' || k), '0') AS dedup_key FROM {MESSAGES}")
def dedup_hash(spark, data):
    return run(spark, data, DETAILS).rows.select("dedup_key")


FAMILIES = [
    {"name": "source", "value": "$.header.source"},
    {"name": "meta:stamp", "value": "$.header.timestamp"},
    {"name": "k", "value": "$.data.k", "colFamily": "body"},
    {"name": "note", "value": "$.data.note", "colFamily": "notes"},
]


@query(
    "split_families",
    f"""SELECT id AS row_key, 'f' AS family, '{{"source":"' || source || '"}}' AS cells FROM {MESSAGES}
        UNION ALL SELECT id, 'meta', '{{"stamp":"' || stamp || '"}}' FROM {MESSAGES}
        UNION ALL SELECT id, 'body', '{{"k":"' || k || '"}}' FROM {MESSAGES}
        UNION ALL SELECT id, 'notes', '{{"note":"' || note || '"}}' FROM {MESSAGES} WHERE note <> ''""",
)
def split_families(spark, data):
    """One row per family that has a cell."""
    spec = {**DETAILS, "templates": [template("details", "details", FAMILIES, ["$.data.id"])]}
    return as_text(run(spark, data, spec).rows).select("row_key", "family", "cells")


def order_documents(spark, data):
    """Orders as documents with their lines, and each line with its codes."""
    line = F.struct(
        F.col("l_linenumber").alias("n"),
        F.col("l_partkey").alias("part"),
        F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).alias("codes"),
    )
    lines = table(spark, data, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    heads = table(spark, data, "orders").select("o_orderkey", "o_orderpriority")
    whole = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), "lines"))
    joined = heads.join(lines, heads["o_orderkey"] == lines["l_orderkey"])
    return joined.select(F.lit("order").alias("topic"), whole.alias("value"))


ORDER_SPEC = {
    "version": "0.4.1",
    "templates": [
        template(
            "order",
            "orders",
            [{"name": "priority", "value": "$.priority"}],
            ["$.id"],
            children=[{"template": "line", "select": "$.lines"}],
        ),
        template(
            "line",
            "lines",
            [{"name": "part", "value": "$.part"}, {"name": "order", "value": "../$.id"}],
            ["../$.id", "$.n"],
            children=[{"template": "codes", "select": "$.codes"}],
        ),
        template(
            "codes",
            "codes",
            [{"name": "flag", "value": "$.flag"}, {"name": "label", "value": "concat(../../$.priority, '/', $.status)"}],
            ["../../$.id", "../$.n"],
        ),
    ],
    "sourceMap": [{"sourceName": "orders", "templates": ["order"], "when": "topic = 'order'", "idockey": ["$.id"]}],
}


@query(
    "child_rows",
    """SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS row_key, '{"priority":"' || o_orderpriority || '"}' AS cells
         FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
       UNION ALL SELECT 'lines', o_orderkey || '-' || l_linenumber, '{"part":"' || l_partkey || '","order":"' || o_orderkey || '"}'
         FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       UNION ALL SELECT 'codes', o_orderkey || '-' || l_linenumber,
         '{"flag":"' || l_returnflag || '","label":"' || o_orderpriority || '/' || l_linestatus || '"}'
         FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def child_rows(spark, data):
    """Children two levels deep, with values of their parent and grandparent."""
    rows = op.map_documents(order_documents(spark, data), ORDER_SPEC).rows
    return as_text(rows).select("table_name", "row_key", "cells")


PATHS_SPEC = {
    "version": "0.4.1",
    "badValues": "null",
    "templates": [
        template(
            "order",
            "paths",
            [
                {"name": "first", "value": "$.lines[*].part"},
                {"name": "last", "value": "$.lines[-1].part"},
                {"name": "all", "value": "concat('', $.lines[*].n)"},
                {"name": "returned", "value": "concat('', $.lines[?(@.n > 1)].n)"},
                {"name": "flags", "value": "concat('', $..flag)"},
                {"name": "number", "value": "CAST($.priority AS INT)"},
            ],
            ["$.id"],
        )
    ],
    "sourceMap": [{"sourceName": "orders", "templates": ["order"], "when": "NOT coalesce($.priority == 7, false)", "idockey": ["$.id"]}],
}


@query(
    "map_paths",
    """WITH l AS (SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
       SELECT CAST(o_orderkey AS VARCHAR) AS row_key, CAST(arg_min(l_partkey, (l_linenumber, l_partkey)) AS VARCHAR) AS first,
         CAST(arg_max(l_partkey, (l_linenumber, l_partkey)) AS VARCHAR) AS last, string_agg(l_linenumber, '' ORDER BY l_linenumber) AS all_lines,
         string_agg(l_linenumber, '' ORDER BY l_linenumber) FILTER (l_linenumber > 1) AS later,
         string_agg(l_returnflag, '' ORDER BY l_linenumber, l_partkey, l_returnflag) AS flags,
         CAST(NULL AS VARCHAR) AS number FROM l GROUP BY 1""",
)
def map_paths(spark, data):
    """Wildcards, last elements, filters and descents in values; a text that is no number is no cell."""
    cells = F.col("cells")
    named = {"first": "first", "last": "last", "all_lines": "all", "later": "returned", "flags": "flags", "number": "number"}
    rows = op.map_documents(order_documents(spark, data), PATHS_SPEC).rows
    return rows.select("row_key", *[F.try_element_at(cells, F.lit(k)).alias(n) for n, k in named.items()])


FILTERED_SPEC = {
    "version": "0.4.1",
    "templates": [
        template("order", "orders", [{"name": "priority", "value": "$.priority"}], ["$.id"], children=[{"template": "line", "select": "$.lines[?(@.n >= 3)]"}]),
        template("line", "lines", [{"name": "part", "value": "$.part"}, {"name": "flags", "value": "$.codes[?(@.flag)].flag"}], ["../$.id", "$.n"]),
    ],
    "sourceMap": [{"sourceName": "orders", "templates": ["order"], "when": "topic = 'order'", "idockey": ["$.id"]}],
}


@query(
    "child_rows_filtered",
    """SELECT o_orderkey || '-' || l_linenumber AS row_key, '{"part":"' || l_partkey || '","flags":"' || l_returnflag || '"}' AS cells
         FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber >= 3""",
)
def child_rows_filtered(spark, data):
    """Children that a filter chooses, with a value behind another filter."""
    rows = op.map_documents(order_documents(spark, data), FILTERED_SPEC).rows.filter("table_name = 'lines'")
    return as_text(rows).select("row_key", "cells")


ROUTED = {
    "version": "0.4.1",
    "templates": [
        template("one", "t_one", [{"name": "k", "value": "$.data.k"}], ["$.data.id"]),
        template("two", "t_two", [{"name": "k", "value": "$.data.k"}], ["$.data.id", "'two'"]),
    ],
    "sourceMap": [
        {"sourceName": "clicks", "templates": ["one"], "when": "( ( topic == 'click' ) && ( $.data.k >= '5' ) )", **KEYS},
        {"sourceName": "many", "templates": ["one", "two"], "when": "topic == 'click' || topic == 'view'", **KEYS},
        {"sourceName": "never", "templates": ["two"], **KEYS},
    ],
}


@query(
    "source_routing",
    f"""SELECT event_type AS topic, 'clicks' AS source_name, 't_one' AS table_name, id AS row_key FROM {MESSAGES}
          WHERE event_type = 'click' AND k >= '5'
        UNION ALL SELECT event_type, 'many', 't_one', id FROM {MESSAGES} WHERE event_type IN ('click', 'view')
        UNION ALL SELECT event_type, 'many', 't_two', id || '-two' FROM {MESSAGES} WHERE event_type IN ('click', 'view')""",
)
def source_routing(spark, data):
    """A message may match several source maps; one without a condition never applies."""
    return run(spark, data, ROUTED).rows.select("topic", "source_name", "table_name", "row_key")


BY_TOPIC = {
    "version": "0.2.1",
    "templates": [
        {
            "name": "old",
            "rows": [
                {
                    "name": "t_old",
                    "namespace": "shop",
                    "col_family": "f",
                    "cols": [["k", "$.data.k"], ["source", "$.header.source"]],
                    "rowkey": ["$.data.id", "$.header.source"],
                    "deDupCols": ["k"],
                }
            ],
        }
    ],
    "kafka-topics": [
        {"topic": "click", "templates": ["old"], **KEYS},
        {"topic": "signup", "templates": ["old"], **KEYS},
    ],
}


@query(
    "topic_templates",
    f"""SELECT event_type AS topic, id || '-' || source AS row_key, ltrim(md5(k), '0') AS dedup_key FROM {MESSAGES}
        WHERE event_type IN ('click', 'signup')""",
)
def topic_templates(spark, data):
    """The older dialect: templates are chosen by topic."""
    return run(spark, data, BY_TOPIC).rows.select("topic", "row_key", "dedup_key")


HELPER_COLS = {
    "upper": "toUpper($.header.category)",
    "lower": "toLower(concat('K', $.data.k))",
    "bare": "trim(concat('  ', $.data.note, ' '))",
    "joined": "join('|', $.header.source, $.data.gone, $.data.k)",
    "digits": "matches($.data.k, '[0-9]{2}')",
    "part": "subString($.header.timestamp, 4, 6)",
    "tail": "subString($.header.source, 1, 0)",
    "rounded": "round(concat('-', $.data.k, '.5'))",
    "blank": "not($.data.note)",
    "class": "if $.data.k >= 50 && $.header.category == 'view' then 'seen' else if $.data.note then concat('n', $.data.k) else 'none'",
    "later": "now() > 1700000000000",
    "top": "topHli($.data.id)",
    "sum": "$.data.k + 1",
    "context": "concat(topic, '!')",
}


@query(
    "map_functions",
    f"""SELECT upper(event_type) AS "upper", 'k' || k AS lower, nullif(note, '') AS bare, source || '||' || k AS joined,
          CASE WHEN regexp_full_match(k, '[0-9]{{2}}') THEN 'true' ELSE 'false' END AS digits, substr(stamp, 5, 2) AS part, substr(source, 2) AS tail,
          (-(k::BIGINT))::VARCHAR AS rounded, CASE WHEN note = '' THEN 'true' ELSE 'false' END AS blank,
          CASE WHEN k::INT >= 50 AND event_type = 'view' THEN 'seen' WHEN note <> '' THEN 'n' || k ELSE 'none' END AS class, 'true' AS later,
          id AS top, (k::BIGINT + 1)::VARCHAR AS sum, event_type || '!' AS context FROM {MESSAGES}""",
)
def map_functions(spark, data):
    """The helper functions in values of a spec."""
    cols = [{"name": n, "value": v} for n, v in HELPER_COLS.items()]
    spec = {**DETAILS, "templates": [template("details", "details", cols, ["id"])]}
    rows = run(spark, data, spec).rows
    return rows.select(*[F.col("cells").getItem(n).alias(n) for n in HELPER_COLS])


@query(
    "reject_bad_values",
    f"""SELECT 'row' AS kind, id, NULL AS failed, (k::INT + 1)::VARCHAR AS next FROM {MESSAGES} WHERE k::INT % 5 <> 0 AND event_type <> 'view'
        UNION ALL SELECT 'reject', id, CASE WHEN event_type = 'view' THEN CASE WHEN k::INT % 5 = 0 THEN 'next,part' ELSE 'part' END ELSE 'next' END, NULL
        FROM {MESSAGES} WHERE k::INT % 5 = 0 OR event_type = 'view'
        UNION ALL SELECT 'reject', NULL, NULL, NULL FROM events WHERE event_type = 'error'""",
)
def reject_bad_values(spark, data):
    """Messages with a value that fails have no rows, and are told with the columns that failed."""
    cols = [
        {"name": "next", "value": "if $.data.k % 5 == 0 then CAST(concat('x', $.data.k) AS INT) else $.data.k + 1"},
        {"name": "part", "value": "subString($.data.note, 0, 5)"},
    ]
    out = run(spark, data, {**DETAILS, "templates": [template("details", "details", cols, ["$.data.id"])]})
    rows = out.rows.select(F.lit("row").alias("kind"), F.col("row_key").alias("id"), F.lit(None).cast("string").alias("failed"), F.col("cells")["next"].alias("next"))
    told = out.rejects.select(F.lit("reject").alias("kind"), F.get_json_object("value", "$.data.id").alias("id"), "failed", F.lit(None).cast("string").alias("next"))
    return rows.unionByName(told)


@query("sort_key", f"SELECT id AS row_key, stamp || '-' || event_type AS sort_key FROM {MESSAGES}")
def sort_key(spark, data):
    spec = {**DETAILS, "templates": [template("details", "details", COLS, ["$.data.id"])]}
    return run(spark, data, spec).rows.select("row_key", "sort_key")


@query("doc_ids", f"SELECT DISTINCT event_type AS topic, id AS doc_id FROM {MESSAGES}")
def doc_ids(spark, data):
    """Ids of all messages, matched by a source map or not."""
    return run(spark, data, ROUTED).doc_ids


@query("multi_line_messages", f"SELECT id AS row_key FROM {MESSAGES}")
def multi_line_messages(spark, data):
    """Records hold several JSON texts, one per line, with blank lines between."""
    df = messages(spark, data, "event_id").filter("value <> '{broken'")
    packed = df.groupBy(F.expr("event_id div 5").alias("record")).agg(F.concat_ws("\n \n", F.collect_list("value")).alias("value"))
    spec = {**DETAILS, "templates": [template("details", "details", COLS, ["$.data.id"])]}
    return op.map_documents(packed.withColumn("topic", F.lit("t")), spec).rows.select("row_key")


@query("reject_frame", "SELECT '{broken' AS value, count(*) AS n FROM events WHERE event_type = 'error'")
def reject_frame(spark, data):
    return run(spark, data, DETAILS).rejects.groupBy("value").agg(F.count("*").alias("n"))


@query("parse_mapped_rows", f"SELECT source || '-' || k || '-one-?' AS row_key, source, 'details' AS table_name FROM {MESSAGES}")
def parse_mapped_rows(spark, data):
    rows = run(spark, data, DETAILS).rows.drop("topic", "source_name")
    text = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    return op.parse_mapped_rows(text).selectExpr("row_key", "cells['source'] AS source", "table_name")


@query("catalog_qualifiers", f"SELECT source, k FROM (SELECT DISTINCT source, k FROM {MESSAGES})")
def catalog_qualifiers(spark, data):
    """The cell table's columns come from the mapping that fills it."""
    from flowframe.operators import cells

    rows = run(spark, data, DETAILS).rows
    names = op.catalog_qualifiers(DETAILS, "details")
    latest = cells.cells_latest(cells.mapped_cells(rows), list(names), "f")
    return latest.select("source", "k").distinct()
