"""Quality rules: hashed n-gram likelihood ratios between trusted and raw text.

The words and word pairs of a text are hashed into buckets. Two multinomials over the buckets,
one of trusted texts and one of all texts, give each bucket a log ratio; a text's verdict is its
mean ratio, which does not depend on its length. Everything is a DataFrame expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import NOT_WORD, WORD, bounded_ids, fold

BUCKETS = 1 << 14
#: Trusted texts that the target is counted on: those with the smallest hashed ids.
MAX_TRUSTED = 50_000
SMOOTHING = 20.0
#: Texts with a mean log ratio below this are left out.
LEAST_RATIO = -0.04
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOL = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null."""
    parts = F.split(F.coalesce(text, F.lit("")), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def buckets_of(hashes: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all words and of all pairs of neighbours, from the words' hashes."""
    firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0)))
    seconds = F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0)))
    pairs = F.zip_with(firsts, seconds, lambda a, b: F.xxhash64(a, b))
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def with_repeated_words(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds the number of words in 3-word windows that stand twice or more, each word counted once.

    Where the hashed windows are not all different they are sorted with their places; those with
    an equal neighbour are repeated. Of their sorted places each covers the words up to the next,
    three at most. Arrays that a lambda looks into are columns, or it would make them anew for
    every element.
    """
    n = F.size(hashes)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )
    df = df.withColumn("_windows", F.when(n >= 3, windows))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed))
    again = F.filter(
        "_sorted",
        lambda x, k: F.coalesce(x["h"] == F.get("_sorted", k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("_sorted", k + 1)["h"], F.lit(False)),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(again, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_windows", "_sorted")


def log_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING
) -> list[float]:
    """The log ratio of each bucket's shares in trusted and raw text; all 0 without trusted texts.

    `trusted` has the ids of the trusted rows and is bounded by its caller; the raw counts are of
    all rows. Counts are combined before their shuffle, so each task sends a row per bucket at
    most, and the driver gets one.
    """
    words = docs.select("doc_id", hashes_of(words_of(F.col("text"))).alias("hashes"))
    flagged = words.join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("_trusted"))), "doc_id", "left")
    grams = flagged.select("_trusted", F.explode(buckets_of(F.col("hashes"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for bucket, r, t in counts:
        raw[bucket], target[bucket] = r, t
    if not sum(target):
        return [0.0] * buckets
    all_raw, all_target = sum(raw) + smoothing * buckets, sum(target) + smoothing * buckets
    return [math.log((t + smoothing) / all_target * all_raw / (r + smoothing)) for r, t in zip(raw, target, strict=True)]


def judge(docs: DataFrame, ratios: list[float], least_ratio: float = LEAST_RATIO) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, mean_ratio and kept of every row.

    A null text counts as empty. A text without words fails the base rules and has mean ratio 0.
    One projection: nothing is shuffled. The ratios, whose number is fixed, are a literal of it.
    """
    split = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("words", words_of(F.col("text")))
    split = with_repeated_words(split.withColumn("hashes", hashes_of(F.col("words"))), "hashes", "n_repeat_words")
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_count(x, F.lit(WORD)) > 0)
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        "n_repeat_words",
        buckets_of(F.col("hashes"), len(ratios)).alias("grams"),
    )
    table = F.from_json(F.lit("[" + ",".join(f"{r:.6f}" for r in ratios) + "]"), "array<double>")
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(table, g))
    base = counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)).alias("mean_ratio"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return base.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("mean_ratio") >= least_ratio))


def quality_rules(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """The verdicts on `docs`, with the rows of label quality 1 as trusted text.

    Held-out labels are never read. Without labels every mean ratio is 0 and the base rules decide.
    """
    good = labels.where((F.col("quality") == 1) & (fold(F.col("doc_id"), folds) != held))
    trusted = bounded_ids(good, "doc_id", MAX_TRUSTED)
    return judge(docs, log_ratios(docs, trusted))
