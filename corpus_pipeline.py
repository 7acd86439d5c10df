"""From raw documents to packed sequences: stages of the text operators, each written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm import language, lines, mixing, ngrams, packing
from flowframe.llm.common import fold
from flowframe.session import scratch_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are in; the others go."""
    held = fold(F.col("doc_id"), 4) == 2
    profiles = language.learn_profiles(docs, ~held)
    return language.accepted(docs, profiles, language.learn_least(docs, held, profiles))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line once in the corpus, also where copies differ by an edit or two."""
    return lines.dedup_lines(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word sets with a similarity of 0.8 or more."""
    return ngrams.keep_one(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights by repeating documents."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of a fixed length: one row per piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Edit distance, learned models and tokenizers can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}-{name}")
        docs = spark.read.parquet(f"{root}/{i}-{name}")
    return docs
