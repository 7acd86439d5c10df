"""Queries of landing and data quality.

The drop is written from the suppliers: files by nation, in several header layouts, some of
them with a fault. The oracle tells from the nation which rows must land.
"""

from functools import reduce

from pyspark.sql import functions as F

from flowframe.catalog import query, table
from flowframe.operators.columns import safe_name
from flowframe.operators.relational import union_ragged
from flowframe.operators.validate import rules_from, validate_fields
from flowframe.plans import delta
from flowframe.session import scratch_dir
from flowframe.sources import landing

PATTERN = "dd.MM.yyyy HH:mm"
KEYS = ["supp key"]
STAMP = ["day", "time"]


def supplier_lines(spark, data):
    """Supplier rows with a day and a time that depend on the row."""
    return table(spark, data, "supplier").select(
        F.col("s_suppkey").cast("string").alias("supp key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("nation"),
        F.concat(F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0"), F.lit(".03.2021")).alias("day"),
        F.lit("10:30").alias("time"),
        F.col("s_nationkey").alias("part"),
    )


def write_drop(spark, data, parts):
    """Write a drop: `parts` is (directory, condition, columns in order)."""
    root = scratch_dir(spark, "drop")
    rows = supplier_lines(spark, data)
    for name, cond, cols in parts:
        rows.filter(cond).select(*cols).write.option("header", "true").csv(f"{root}/2021/03/{name}")
    return root


def rename(col, name):
    return F.col(col).alias(name)


GOOD = ["supp key", "name", "nation", "day", "time"]


def layouts():
    """(directory, condition, columns) of each part of the drop, good and faulty ones."""
    return [
        ("01", "part < 5", GOOD),
        # another order, a column more, a blank header
        ("02", "part BETWEEN 5 AND 9", ["nation", "time", "supp key", "day", "name", F.lit("x").alias("extra col"), F.lit("y").alias(" ")]),
        # the same rows later: duplicates
        ("03", "part < 3", ["supp key", "name", "nation", F.lit("31.03.2021").alias("day"), "time"]),
        # no key column
        ("04", "part BETWEEN 10 AND 12", [rename("supp key", "id"), "name", "nation", "day", "time"]),
        # a repeated name
        ("05", "part BETWEEN 13 AND 14", ["supp key", "name", rename("nation", "dup"), rename("name", "dup"), "day", "time"]),
        # no timestamp in any row
        ("06", "part BETWEEN 15 AND 17", ["supp key", "name", "nation", rename("name", "day"), "time"]),
        # no timestamp column
        ("07", "part BETWEEN 18 AND 19", ["supp key", "name", "nation", "day"]),
        # some rows without a key
        ("08", "part > 19", [F.when(F.col("part") < 23, F.col("supp key")).alias("supp key"), "name", "nation", "day", "time"]),
    ]


def drop(spark, data):
    """The drop written without repeated header names, which a frame cannot hold."""
    root = write_drop(spark, data, [p for p in layouts() if p[0] != "05"])
    rows = supplier_lines(spark, data).filter("part BETWEEN 13 AND 14")
    line = F.concat_ws(",", "supp key", "name", "nation", "name", "day", "time").alias("value")
    header = spark.range(1).select(F.lit("supp key,name,dup,dup,day,time").alias("value"))
    header.unionByName(rows.select(line)).coalesce(1).write.text(f"{root}/2021/03/05")
    return root


def landed(spark, data):
    return landing.land_csv(spark, drop(spark, data), KEYS, STAMP, PATTERN, "America/Sao_Paulo")


# rows that land: nations 0-9 and 20-22; three hours are between zone and UTC
STAMPED = "'2021-03-' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') || 'T13:30:00.000Z'"
LANDED = f"""(SELECT CAST(s_suppkey AS VARCHAR) AS supp_key, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation,
  CASE WHEN s_nationkey BETWEEN 5 AND 9 THEN 'x' END AS extra_col, {STAMPED} AS "DERIVED_TS"
  FROM supplier WHERE s_nationkey < 10 OR s_nationkey BETWEEN 20 AND 22)"""


@query("land_csv", f"SELECT * FROM {LANDED}")
def land_csv(spark, data):
    """Whole files fail; rows without a key are left out; columns are matched by name.

    Rows that came again on a later day are duplicates: timestamps are not compared.
    """
    return landed(spark, data).rows.select("supp_key", "name", "nation", "extra_col", "DERIVED_TS")


@query("land_csv_projected", f"""SELECT supp_key AS id, name AS label, "DERIVED_TS" FROM {LANDED}""")
def land_csv_projected(spark, data):
    """Chosen and renamed columns; a row that came twice stays with its older timestamp."""
    cols = {"supp key": "id", "name": "label"}
    rows = landing.land_csv(spark, drop(spark, data), KEYS, STAMP, PATTERN, "America/Sao_Paulo", cols).rows
    return rows.select("id", "label", "DERIVED_TS")


# every part has a file, be it one with a header only; a part without rows has no bad timestamp
VERDICT = """(SELECT part, CASE part WHEN '04' THEN 'missing_key_columns' WHEN '05' THEN 'duplicate_columns'
  WHEN '06' THEN CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_nationkey BETWEEN 15 AND 17) THEN 'unparsable_timestamp' END
  WHEN '07' THEN 'missing_timestamp_columns' END AS error_type
  FROM (SELECT unnest(['01', '02', '03', '04', '05', '06', '07', '08']) AS part))"""
HELD = """(SELECT DISTINCT unnest(CASE WHEN s_nationkey < 3 THEN ['01', '03'] WHEN s_nationkey < 5 THEN ['01'] WHEN s_nationkey < 10 THEN ['02']
  WHEN s_nationkey < 13 THEN ['04'] WHEN s_nationkey < 15 THEN ['05'] WHEN s_nationkey < 18 THEN ['06'] WHEN s_nationkey < 20 THEN ['07'] ELSE ['08'] END) AS part
  FROM supplier)"""


def by_directory(verdicts):
    return verdicts.select(F.element_at(F.split("path", "/"), -2).alias("part"), "error_type").distinct()


@query("dq_verdicts", f"SELECT part, error_type FROM {VERDICT}")
def dq_verdicts(spark, data):
    return by_directory(landed(spark, data).verdicts)


@query("dq_key_columns", f"SELECT part FROM {VERDICT} WHERE error_type = 'missing_key_columns'")
def dq_key_columns(spark, data):
    return by_directory(landed(spark, data).verdicts).filter("error_type = 'missing_key_columns'").select("part")


@query("dq_duplicate_columns", f"SELECT part FROM {VERDICT} WHERE error_type = 'duplicate_columns'")
def dq_duplicate_columns(spark, data):
    return by_directory(landed(spark, data).verdicts).filter("error_type = 'duplicate_columns'").select("part")


@query("dq_timestamp", f"SELECT part FROM {VERDICT} WHERE error_type IN ('unparsable_timestamp', 'missing_timestamp_columns')")
def dq_timestamp(spark, data):
    found = by_directory(landed(spark, data).verdicts)
    return found.filter("error_type IN ('unparsable_timestamp', 'missing_timestamp_columns')").select("part")


@query(
    "quarantine",
    """SELECT CASE WHEN s_nationkey < 13 THEN 'missing_key_columns' WHEN s_nationkey < 15 THEN 'duplicate_columns'
         WHEN s_nationkey < 18 THEN 'unparsable_timestamp' ELSE 'missing_timestamp_columns' END AS error_type, count(*) AS rows
       FROM supplier WHERE s_nationkey BETWEEN 10 AND 19 GROUP BY 1""",
)
def quarantine(spark, data):
    bad = landed(spark, data).quarantine
    return bad.groupBy(F.col("__errortype__").alias("error_type")).agg(F.count("*").alias("rows"))


@query(
    "error_rows",
    """SELECT s_name AS name, CASE WHEN s_nationkey < 13 THEN 'missing_key_columns' WHEN s_nationkey < 15 THEN 'duplicate_columns'
         WHEN s_nationkey < 18 THEN 'unparsable_timestamp' ELSE 'missing_timestamp_columns' END AS error_type, true AS told
       FROM supplier WHERE s_nationkey BETWEEN 10 AND 19""",
)
def error_rows(spark, data):
    """Rows of failed files with their error, for a preview."""
    bad = landed(spark, data).quarantine
    return bad.select("name", F.col("__errortype__").alias("error_type"), (F.col("__error__") != "").alias("told"))


@query("derive_ts", f"SELECT s_suppkey, {STAMPED} AS ts, false AS failed FROM supplier")
def derive_ts(spark, data):
    df = supplier_lines(spark, data).withColumn("s_suppkey", F.col("supp key").cast("bigint"))
    out = landing.with_derived_ts(df, STAMP, PATTERN, "America/Sao_Paulo")
    return out.select("s_suppkey", F.col("DERIVED_TS").alias("ts"), (F.col("PARSE_ERROR") != "").alias("failed"))


@query("require_keys", "SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3")
def require_keys(spark, data):
    df = table(spark, data, "supplier").select("s_suppkey", F.nullif(F.col("s_nationkey"), F.lit(3)).alias("k"))
    return landing.require_keys(df, ["k"]).select("s_suppkey")


@query("require_missing_key", "SELECT count(*) AS n FROM supplier WHERE false")
def require_missing_key(spark, data):
    """A key column the frame lacks is null in every row."""
    return landing.require_keys(table(spark, data, "supplier"), ["nothing"]).agg(F.count("*").alias("n"))


@query("drop_blank_headers", "SELECT s_suppkey, s_name AS _code FROM supplier")
def drop_blank_headers(spark, data):
    """Blank headers go by their position; a name that only looks like one of theirs stays."""
    group = landing.HeaderGroup("s_suppkey,,_code,", ["s_suppkey", "", "_code", ""], [])
    df = table(spark, data, "supplier").select("s_suppkey", F.lit("").alias("_c1"), F.col("s_name").alias("_code"), F.lit("").alias("_c3"))
    return landing.drop_blank_headers(df, group)


@query("tag_file", f"SELECT part, part <> '05' AS named, true AS dated FROM {HELD}")
def tag_file(spark, data):
    """Rows carry the name and the modification time of their file."""
    root = drop(spark, data)
    groups = landing.header_groups(spark, root)
    rows = reduce(union_ragged, [landing.read_group(spark, g, ",") for g in groups])
    tagged = rows.select(
        F.element_at(F.split(landing.FILE, "/"), -2).alias("part"),
        F.col("FILENAME_TS").endswith(".csv").alias("named"),
        F.col("LAST_MODIFIED_TS").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$").alias("dated"),
    )
    return tagged.distinct()


@query("land_newest", "SELECT CAST(s_suppkey AS VARCHAR) AS supp_key FROM supplier WHERE s_nationkey BETWEEN 5 AND 9 OR s_nationkey BETWEEN 20 AND 22")
def land_newest(spark, data):
    """Only what differs from the landed snapshot in more than its timestamps."""
    now = landed(spark, data).rows.select("supp_key", "name", "nation", "DERIVED_TS")
    before = now.filter("CAST(nation AS INT) < 5")
    return landing.land_newest(now, before)[0].select("supp_key")


@query("month_paths", "SELECT 1::BIGINT AS months, count(*) AS rows FROM supplier WHERE s_nationkey < 5")
def month_paths(spark, data):
    """Only the months asked for are read."""
    root = write_drop(spark, data, [("01", "part < 5", GOOD)])
    supplier_lines(spark, data).select(*GOOD).write.option("header", "true").csv(f"{root}/2021/05/01")
    found = landing.month_paths(spark, root, "202102", "202104")
    rows = landing.land_csv(spark, found, KEYS, STAMP, PATTERN).rows
    months = F.count_distinct(F.substring("DERIVED_TS", 1, 7)).alias("months")
    return rows.agg(months, F.count("*").alias("rows"))


def months_drop(spark, data):
    """Suppliers by month: nations 0-9 in March, 5-14 again and later in May, 15-24 in June up to a day each."""
    root = scratch_dir(spark, "drop")
    rows = supplier_lines(spark, data)
    day = lambda month: F.concat(F.lpad((F.col("part") + 1).cast("string"), 2, "0"), F.lit(f".{month}.2021")).alias("day")
    for month, cond in (("03", "part < 10"), ("05", "part BETWEEN 5 AND 14"), ("06", "part >= 15")):
        rows.filter(cond).select("supp key", "name", "nation", day(month), "time").write.option("header", "true").csv(f"{root}/2021/{month}/01")
    return root


FROM_MONTHS = """(SELECT CAST(s_suppkey AS VARCHAR) AS supp_key, s_nationkey AS nation, '2021-' || CASE WHEN s_nationkey < 10 THEN '03' WHEN s_nationkey < 15 THEN '05' ELSE '06' END
  || '-' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') || 'T10:30:00.000Z' AS "DERIVED_TS" FROM supplier)"""


@query("land_initial", f"""SELECT supp_key, "DERIVED_TS" FROM {FROM_MONTHS} WHERE nation < 20""")
def land_initial(spark, data):
    """Drops of several months as one, up to a day: rows that came again keep their oldest time."""
    rows = landing.land_initial(spark, months_drop(spark, data), "202102", "20210620", KEYS, STAMP, PATTERN).rows
    return rows.select("supp_key", "DERIVED_TS")


@query(
    "land_resume",
    f"""SELECT 'new' AS part, supp_key, "DERIVED_TS" FROM {FROM_MONTHS} WHERE nation >= 10 AND nation < 20
        UNION ALL SELECT 'previous', supp_key, "DERIVED_TS" FROM {FROM_MONTHS} WHERE nation < 10""",
)
def land_resume(spark, data):
    """A flow whose landing goes on from what was landed: March is known, May and June are new."""
    root, clean = months_drop(spark, data), scratch_dir(spark, "clean")
    landing.land_initial(spark, root, "202103", "202103", KEYS, STAMP, PATTERN).rows.write.parquet(clean)
    spec = {
        "connections": [{"id": "drop", "connectionType": "local", "options": {"path": root}}],
        "operations": [
            {
                "operatorType": "preprocessor",
                "signals": {"sources": [{"connectionId": "drop"}], "sinks": [{"signalId": "suppliers"}]},
                "options": {
                    "keyCols": KEYS, "srcTimestamp": STAMP, "srcTimestampFormat": PATTERN, "from": "202101", "till": "202112",
                    "cleanDataPath": clean, "cleanDataFormat": "parquet",
                },
            }
        ],
    }
    got = delta.flow_changes(spark, spec, "suppliers", "2021-03-31", "2021-06-20T23:59:59")
    parts = [df.select(F.lit(n).alias("part"), "supp_key", "DERIVED_TS") for n, df in (("new", got.gained), ("previous", got.before))]
    return parts[0].unionByName(parts[1])


RULES = {"validations": [["c_custkey", "^[0-9]+$"], ["c_mktsegment", "^[A-Z]+$"], ["orders.o_orderkey", "[0-9]"], ["orders.o_orderpriority", "^[1-4]"]]}


@query(
    "validate_fields",
    """SELECT c_custkey, 'c_name' AS field, c_name AS value, 'MissingMapping' AS violation FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
       UNION ALL SELECT o_custkey, 'orders.o_orderpriority', o_orderpriority, 'InvalidFormat' FROM orders WHERE o_orderpriority = '5-LOW'
       UNION ALL SELECT o_custkey, 'orders.o_orderstatus', o_orderstatus, 'MissingMapping' FROM orders WHERE o_orderstatus = 'P'""",
)
def validate(spark, data):
    nested = (
        table(spark, data, "orders")
        .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.col("o_orderstatus")))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus"))).alias("orders"))
    )
    df = table(spark, data, "customer").select("c_custkey", "c_name", "c_mktsegment").join(nested, "c_custkey")
    return validate_fields(df, rules_from(RULES), ["c_custkey"])


@query("safe_name", "SELECT r_regionkey AS a_b, r_name AS c_d_ FROM region")
def safe_names(spark, data):
    return table(spark, data, "region").toDF(safe_name(" a b "), safe_name("c.d%"))
