"""Database tables and event buses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.columns import filter_rows, project as project_cols


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    options: dict[str, str] | None = None,
    project=None,
    where: str = "",
) -> DataFrame:
    """A table or query; `partition` is (numeric column, low, high, number of tasks).

    Without `partition` one task reads everything, so large tables should name one.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    reader = spark.read.format("jdbc").option("url", url)
    given = {"user": user, "password": password, "driver": driver}
    reader = reader.options(**{k: v for k, v in given.items() if v}, **(options or {}))
    if partition:
        column, low, high, tasks = partition
        source = table or f"({query}) partitioned_query"
        reader = reader.options(
            dbtable=source, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=tasks
        )
    else:
        reader = reader.option("dbtable", table) if table else reader.option("query", query)
    df = reader.load()
    if project:
        df = project_cols(df, project)
    return filter_rows(df, where)


def bus_options(servers: str, topics: str, start: str = "earliest", rate: int | None = None, group: str | None = None):
    """Options of the Kafka source. A bounded read has to start at the earliest offsets, the default;
    a stream may start at the latest."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": "earliest" if start in ("earliest", "smallest") else "latest",
    }
    if group:
        options["groupIdPrefix"] = group
    if rate:
        options["maxOffsetsPerTrigger"] = str(rate)
    return options


def read_event_bus(spark: SparkSession, servers: str, topics: str, schema: str | None = None, **kwargs) -> DataFrame:
    """A bounded read of an event bus with its JSON bodies as columns (needs the Kafka package)."""
    raw = spark.read.format("kafka").options(**bus_options(servers, topics, **kwargs)).load()
    return parse_bodies(raw.selectExpr("CAST(value AS STRING) AS body"), "body", schema)


def body_schema(df: DataFrame, body: str = "body") -> str:
    """The common schema of JSON bodies as DDL, found by one distributed aggregation."""
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(body))).alias("s")).first()["s"]
    return found.replace("OBJECT<", "STRUCT<")


def parse_bodies(df: DataFrame, body: str = "body", schema: str | None = None) -> DataFrame:
    """JSON bodies as columns; a declared schema spares the pass that finds one."""
    ddl = schema or body_schema(df, body)
    return df.select(F.from_json(F.col(body), ddl).alias("__row")).select("__row.*")
