"""File readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.operators.columns import filter_rows, project as project_cols, quoted
from flowframe.operators.events import earliest_per_row

DEFAULTS = {
    "csv": {"header": "false", "sep": ",", "inferSchema": "true"},
    "avro": {"ignoreExtension": "false"},
}


def resolve_path(*parts: str | None) -> str:
    """Join a connection path and an operator path into one."""
    given = [p for p in parts if p]
    if not given:
        raise ValueError("no path given")
    first, rest = given[0], given[1:]
    return "/".join([first.rstrip("/") if rest else first, *[p.strip("/") for p in rest]])


def connection_uri(kind: str, path: str, container: str = "", account: str = "") -> str:
    """The URI a connection names: an object-store container, HDFS, or a path as it is."""
    if "://" in path or kind in ("local", ""):
        return path
    if kind.startswith("blob-storage"):
        return f"abfs://{container}@{account}/{path.lstrip('/')}"
    if kind.startswith("hdfs"):
        return f"hdfs:///{path.lstrip('/')}"
    return path


def declared(cols: str | Sequence[str]) -> T.StructType:
    """An all-text schema from a comma-separated list of names."""
    names = cols.split(",") if isinstance(cols, str) else cols
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in names])


def read_files(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "text",
    options: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
    project: Sequence[tuple[str, str]] | None = None,
    where: str = "",
) -> DataFrame:
    """Read files of any format Spark knows; project, then filter.

    Both steps are plain plan nodes, so they reach the scan. A declared schema spares the
    extra pass that inferring one costs.
    """
    kind = fmt.lower()
    opts = {**DEFAULTS.get(kind, {}), **(options or {})}
    if schema is not None:
        opts.pop("inferSchema", None)
    reader = spark.read.format(kind).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path if isinstance(path, str) else list(path))
    if project:
        df = project_cols(df, project)
    return filter_rows(df, where) if where and where != "true" else df


def rows_as_json(df: DataFrame, out: str = "value") -> DataFrame:
    """Each row as JSON text; null fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])).alias(out))


def read_month_partitions(
    spark: SparkSession,
    path: str,
    cols: dict[str, str],
    ts: tuple[str, str] | None,
    where: str = "",
    start: str = "",
    till: str = "",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Months start..till of a directory laid out as `yearmonth=YYYYMM`.

    One read: the month range is a partition filter; an end that is not given is open. Columns are chosen and renamed by
    `cols`, `ts` is (source, name), `where` applies to the renamed columns. Rows equal but
    for their timestamp collapse to the earliest. When `till` names a day or time, rows of
    its month after it are left out.
    """
    df = spark.read.format(fmt).options(**(options or {})).load(path)
    month = F.col("yearmonth").cast("string")
    if start:
        df = df.filter(month >= start[:6])
    if till:
        df = df.filter(month <= till[:6])
    picked = [F.col(quoted(src)).alias(name) for src, name in cols.items() if not ts or name != ts[1]]
    if ts:
        picked.append(F.col(quoted(ts[0])).alias(ts[1]))
    df = df.select(*picked, month.alias("__month"))
    if where:
        df = df.filter(where)
    if ts and len(till) > 6:
        df = df.filter((F.col("__month") < till[:6]) | (F.col(ts[1]) <= till))
    df = df.drop("__month")
    return earliest_per_row(df, ts[1]) if ts else df
