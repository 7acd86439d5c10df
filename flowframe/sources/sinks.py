"""Writers. Each prepares a frame with plain columns and hands it to Spark's own writer."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.operators.columns import compact_fields, quoted

SAVE_MODES = {"overwrite": "overwrite", "ignore": "ignore", "errexists": "errorifexists"}


def save_mode(name: str | None) -> str:
    """overwrite (default), ignore, errExists; anything else appends."""
    return SAVE_MODES.get((name or "overwrite").lower(), "append")


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str | None = None,
    options: dict[str, str] | None = None,
    codec: str | None = None,
    partition_cols: Sequence[str] = (),
) -> None:
    """Write with Spark's own writer, as many files as the frame has partitions.

    With `partition_cols` rows are rebalanced by them first: small directories are packed into
    few files, and a directory with a large share of the rows is cut over many tasks.
    """
    opts = {"header": "true"} if fmt.lower() == "csv" else {}
    opts.update(options or {})
    if codec:
        opts["compression"] = codec
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(save_mode(mode)).format(fmt.lower()).options(**opts)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(path)


def write_with_schema(df: DataFrame, path: str, mode: str | None = None) -> None:
    """Write Parquet and, beside it, the schema as JSON text in `<path>.schema`."""
    write_files(df, path, "parquet", mode)
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "value string").write.mode("overwrite").text(f"{path}.schema")


def schema_evolution_read(spark: SparkSession, path: str, schema_path: str) -> DataFrame:
    """Read a directory under a saved schema; text columns it lacks are empty text, others null."""
    text = "".join(r["value"] for r in spark.read.text(schema_path).collect())  # one small document
    saved = T.StructType.fromJson(json.loads(text))
    df = spark.read.parquet(path)
    have = set(df.columns)
    return df.select(
        *[
            F.col(quoted(f.name))
            if f.name in have
            else F.lit("" if isinstance(f.dataType, T.StringType) else None).cast(f.dataType).alias(f.name)
            for f in saved.fields
        ]
    )


def storable(df: DataFrame) -> DataFrame:
    """Columns a database takes as they are; nested ones as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return df.select(
        *[
            F.to_json(F.col(quoted(f.name))).alias(f.name) if isinstance(f.dataType, nested) else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def df_key(keys: Sequence[str]):
    """Key columns joined by `_`, null as empty text; no separator follows an empty prefix."""
    out = F.lit("")
    for k in keys:
        out = F.concat(out, F.when(out != "", F.lit("_")).otherwise(F.lit("")), F.coalesce(F.col(k).cast("string"), F.lit("")))
    return out


def jdbc_frame(df: DataFrame, keys: Sequence[str], flow: str | None = None) -> DataFrame:
    """Distinct rows ready for a database table.

    With `flow`, (df_key, content) where content is the row as JSON with its flow name;
    otherwise every column, nested ones as JSON text, with df_key first.
    """
    rows = df.distinct()
    key = df_key(keys).alias("df_key")
    if flow is None:
        flat = storable(rows.withColumn("df_key", key))
        return flat.select("df_key", *df.columns)
    whole = F.struct(*[F.col(quoted(c)) for c in df.columns], F.lit(flow).alias("flowName"))
    return rows.select(key, F.to_json(whole).alias("content"))


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 30000,
    options: dict[str, str] | None = None,
) -> None:
    """Batched insert by as many connections as the frame has partitions."""
    opts = {"batchsize": str(batch_size), **(options or {})}
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **opts).save()


def bus_frame(df: DataFrame, out: str = "body") -> DataFrame:
    """Each row as a JSON body."""
    return df.select(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])).alias(out))


def write_event_bus(df: DataFrame, servers: str, topic: str) -> None:
    """Send each row as JSON (needs the Kafka package)."""
    out = bus_frame(df, "value").withColumn("topic", F.lit(topic))
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def mapped_bus_frame(rows: DataFrame, routes: dict[str, str], default: str = "unrouted") -> DataFrame:
    """Mapped rows as JSON, each with the topic its table is routed to."""
    topic = F.lit(default)
    for table, name in routes.items():
        topic = F.when(F.col("table_name") == table, F.lit(name)).otherwise(topic)
    body = F.to_json(F.struct(*[F.col(quoted(c)) for c in rows.columns]))
    return rows.select(topic.alias("topic"), body.alias("value"))


def mapped_jdbc_frame(rows: DataFrame) -> DataFrame:
    """Mapped rows with their cells as one JSON text column."""
    return rows.withColumn("cells", F.to_json("cells"))


def raw_partitions(df: DataFrame, topic: str, value: str, ts: str) -> DataFrame:
    """Raw input with the partition columns of its landing tree: topic, month, hour."""
    return df.select(
        F.col(value).alias("value"),
        F.col(topic).alias("topic"),
        F.date_format(ts, "yyyyMM").alias("yearmonth"),
        F.concat(F.date_format(ts, "ddHH"), F.lit("5959")).alias("daytimestamp"),
    )


def store_raw(df: DataFrame, path: str, topic: str, value: str, ts: str, fmt: str = "parquet") -> None:
    """Keep raw input under topic / month / hour; one write for all topics.

    The rebalance before the write packs small partitions and cuts large ones, so a topic
    with most of the input is written by many tasks.
    """
    parts = ["topic", "yearmonth", "daytimestamp"]
    rebalanced = raw_partitions(df, topic, value, ts).hint("rebalance", *parts)
    rebalanced.write.mode("append").format(fmt).partitionBy(*parts).save(path)


def store_mapped(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Mapped rows by table and by the date cells partYYYY, partMM, partDD."""
    cells = F.col("cells")
    dated = rows.withColumns(
        {
            "y": F.coalesce(cells["partYYYY"], F.lit("none")),
            "m": F.coalesce(cells["partMM"], F.lit("none")),
            "d": F.coalesce(cells["partDD"], F.lit("none")),
        }
    )
    parts = ["table_name", "y", "m", "d"]
    dated.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).parquet(path)


def multi_sink(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """One frame to several sinks, computed once."""
    if len(sinks) == 1:
        sinks[0](df)
        return
    kept = df.persist()
    try:
        for sink in sinks:
            sink(kept)
    finally:
        kept.unpersist()


def per_table_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_name").agg(F.count("*").alias("rows"))


def write_counted(rows: DataFrame, tables: Sequence[str], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write mapped rows and return how many went to each of the tables, and to others (`None`).

    The rows are counted on their way through the one write; nothing is read or kept for it.
    `write` must run the frame once.
    """
    seen = Observation()
    of = [F.count_if(F.col("table_name").eqNullSafe(t)).alias(f"t{i}") for i, t in enumerate(tables)]
    write(rows.observe(seen, F.count(F.lit(1)).alias("all"), *of))
    told = seen.get
    counts = {t: told[f"t{i}"] for i, t in enumerate(tables)}
    return {**counts, None: told["all"] - sum(counts.values())}


def compact_files(
    spark: SparkSession, source: str, target: str, fmt: str = "parquet", file_bytes: int = 512 << 20
) -> None:
    """Rewrite many small files as even ones of about `file_bytes` each."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    size = listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]  # lengths come from the listing alone
    df = spark.read.format(fmt).load(source)
    df.repartition(max(1, -(-size // file_bytes))).write.mode("overwrite").format(fmt).save(target)


def document_frame(df: DataFrame, out: str = "value") -> DataFrame:
    """Rows as the JSON documents a mapping takes: no null or empty field, under `data`."""
    return df.select(F.to_json(F.struct(F.struct(*compact_fields(df)).alias("data"))).alias(out))
