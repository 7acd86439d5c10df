"""New-file detection and file streams."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files below a directory; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def settled(files: DataFrame, now: datetime, settle_seconds: int = 600, since: datetime | None = None) -> DataFrame:
    """Non-empty files that have not changed for `settle_seconds`, and are newer than `since`."""
    df = files.filter((F.col("length") > 0) & (F.col("modificationTime") <= F.lit(now - timedelta(seconds=settle_seconds))))
    return df.filter(F.col("modificationTime") > F.lit(since)) if since else df


def matching(files: DataFrame, name: str | None = None, directory: str | None = None) -> DataFrame:
    """Files whose name and directory match regular expressions."""
    leaf = F.element_at(F.split("path", "/"), -1)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    df = files.filter(leaf.rlike(f"^(?:{name})$")) if name else files
    return df.filter(folder.rlike(directory)) if directory else df


def new_files(listed: DataFrame, processed: DataFrame, path: str = "path") -> DataFrame:
    """Files listed now that are not in the table of processed files."""
    return listed.join(processed.select(path).distinct(), path, "left_anti")


def next_files(files: DataFrame, n: int) -> DataFrame:
    """The oldest `n` files, the next batch."""
    return files.orderBy("modificationTime", "path").limit(n)


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    pattern: str | None = None,
    max_files: int | None = None,
    max_age: str | None = None,
    archive: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream over files as they arrive; the checkpoint remembers which were read.

    `archive` moves finished files to a directory that keeps their paths.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    given = {"pathGlobFilter": pattern, "maxFilesPerTrigger": max_files, "maxFileAge": max_age}
    for key, value in given.items():
        if value is not None:
            reader = reader.option(key, str(value))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def bus_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages of a bus as (topic, value); offsets live in the query's checkpoint."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.selectExpr("topic", "CAST(value AS STRING) AS value", "partition", "offset", "timestamp")
