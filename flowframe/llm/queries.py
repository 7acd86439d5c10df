"""The registered queries of the text operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.catalog import table
from flowframe.llm import dialogue, hamming, language, lines, mixing, multiindex, ngrams, packing, quality, rules, toxicity, variants, warc
from flowframe.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


@query("op10_mixing", mixing.MIX_SQL)
def op10_mixing(spark: SparkSession, data: str) -> DataFrame:
    return mixing.mix_report(table(spark, data, "documents"))


@query("op1_warc", warc.WARC_SQL)
def op1_warc(spark: SparkSession, data: str) -> DataFrame:
    return warc.archive_and_read(spark, table(spark, data, "pages"))


@query("op3_packing")
def op3_packing(spark: SparkSession, data: str) -> DataFrame:
    return packing.pack(table(spark, data, "documents"))


@query("op8_language")
def op8_language(spark: SparkSession, data: str) -> DataFrame:
    docs = table(spark, data, "documents")
    held = fold(F.col("doc_id"), 4) == 2
    profiles = language.learn_profiles(docs, ~held)
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op5_quality")
def op5_quality(spark: SparkSession, data: str) -> DataFrame:
    return quality.quality_scores(table(spark, data, "documents"), table(spark, data, "labels"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, data: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, data, "documents"), table(spark, data, "labels"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, data: str) -> DataFrame:
    return rules.quality_rules(table(spark, data, "documents"), table(spark, data, "labels"))


@query("op2_hamming_neighbours")
def op2_hamming_neighbours(spark: SparkSession, data: str) -> DataFrame:
    return hamming.nearest_by_inner_product(
        table(spark, data, "embeddings"), "vec_id", "embedding", F.pmod(F.col("id"), F.lit(20)) == 0
    )


@query("op6_ngram_join")
def op6_ngram_join(spark: SparkSession, data: str) -> DataFrame:
    return ngrams.near_duplicates(table(spark, data, "documents"))


@query("op4_line_dedup", lines.LINES_SQL)
def op4_line_dedup(spark: SparkSession, data: str) -> DataFrame:
    return lines.judged_lines(table(spark, data, "documents"))


@query("op11_multi_index", multiindex.VECTORS_SQL)
def op11_multi_index(spark: SparkSession, data: str) -> DataFrame:
    return multiindex.near_vectors(table(spark, data, "embeddings"))


@query("op12_spelling_variants", variants.VARIANTS_SQL)
def op12_spelling_variants(spark: SparkSession, data: str) -> DataFrame:
    return variants.spelling_variants(table(spark, data, "documents"))


@query("op13_dialogue_repair", dialogue.REPAIR_SQL)
def op13_dialogue_repair(spark: SparkSession, data: str) -> DataFrame:
    return dialogue.repair_report(table(spark, data, "conversations"))
