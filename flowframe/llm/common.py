"""Small helpers that the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.session import scratch_dir

#: Runs of these are words: everything but space and the ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """The number of words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def numbered(docs: DataFrame, *used: str) -> DataFrame:
    """The frame with its columns named c0, c1, ..., but for those that are used: whatever the given
    columns are called, they don't clash with an operator's own."""
    return docs.toDF(*[c if c in used else f"c{i}" for i, c in enumerate(docs.columns)])


def named_back(df: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of `docs`, in their order and under their names, from a frame that came from `numbered`."""
    return df.select(*[F.col(c if c in used else f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def saved(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame, written to the shared folder and read back: it is computed once, and a lost
    executor costs no more than the task that read it."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, f"{label}-{uuid.uuid4().hex[:8]}")


def sum_arrays(df: DataFrame, key: str, vector: str) -> dict[object, np.ndarray]:
    """The sums by key of float64 vectors held as binaries.

    Partial sums meet in a tree of tasks, so the driver gets one dictionary. The keys must be
    few by construction (languages, rows of a fixed matrix); what a task holds is their number
    times the vector's length.
    """

    def within(rows: Iterator) -> Iterator[dict]:
        total: dict = {}
        for r in rows:
            v = np.frombuffer(r[vector], dtype=np.float64)
            k = r[key]
            total[k] = total[k] + v if k in total else v.copy()
        yield total

    def merge(a: dict, b: dict) -> dict:
        for k, v in b.items():
            a[k] = a[k] + v if k in a else v
        return a

    parts = df.select(key, vector).rdd.mapPartitions(within)
    return parts.treeReduce(merge, depth=3) if parts.getNumPartitions() else {}


def hash_share(by: Column, share: Column | float) -> Column:
    """Whether the hash of a value is among the least `share` of all hashes."""
    place = F.xxhash64(by).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    return place <= share


def least_hashed(df: DataFrame, by: str, limit: int, *ties: str) -> DataFrame:
    """At most `limit` rows, those with the least hashes of a column: the same for every run.

    Rows are counted first, and those whose hash is more than twice as large as need be go in the
    scan, so the choice gathers about twice `limit` rows, not `limit` rows of each task.
    """
    n = df.count()
    some = df if n <= 2 * limit else df.where(hash_share(F.col(by), 2.0 * limit / n))
    return some.orderBy(F.xxhash64(by), by, *ties).limit(limit)


def bounded_ids(df: DataFrame, id_col: str, limit: int) -> DataFrame:
    """At most `limit` distinct ids, those with the smallest hashes: the same for every run."""
    return least_hashed(df.select(id_col).where(F.col(id_col).isNotNull()).distinct(), id_col, limit)


#: Rows of whole texts or sets that go to a Python worker at once.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Make Arrow batches small enough for rows of whole texts; the setting stays for the session,
    as frames are run later than they are built."""
    now = int(spark.conf.get(_BATCH_SETTING))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def texts(column: pa.Array) -> list[str]:
    """The texts of an Arrow column, nulls as empty texts."""
    return [t or "" for t in column.to_pylist()]


def crc32_sql(text: str) -> str:
    """crc32 of a text's UTF-8 bytes in SQL, one byte after the other."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, {step}), 4294967295::BIGINT)"
