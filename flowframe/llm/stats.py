"""Statistics of whole texts, as numbers that a score can be fitted on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import bound_batches, texts

NAMES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "stops",
    "punctuation",
    "bars",
    "marks",
    "distinct_words",
    "distinct_lines",
    "words_per_line",
    "one_letter",
    "distinct_pairs",
    "symbol_words",
    "upper_words",
)
_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _COMMA, _BAR, _MARK = range(1, 9)


def _classes() -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    out[65:91], out[97:123], out[48:58] = _UPPER, _LOWER, _DIGIT
    for chars, kind in (("#*$%&<>@^~_=+\\/{}[]", _SYMBOL), (".", _STOP), (",;:", _COMMA), ("|", _BAR), ("!?", _MARK)):
        out[[ord(c) for c in chars]] = kind
    out[128:] = _LOWER
    return out


CLASSES = _classes()
_SYMBOL_BYTES = b"#*$%&<>@^~_=+\\/{}[]|"


def text_stats(text: str) -> np.ndarray:
    """The statistics of one text, in the order of NAMES; all 0 for a text without words."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return np.zeros(len(NAMES))
    n, size = len(words), len(data)
    by_class = np.bincount(CLASSES[np.frombuffer(data, dtype=np.uint8)], minlength=9)
    letters = max(1, by_class[_UPPER] + by_class[_LOWER])
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = set(zip(words, words[1:]))
    symbol_words = sum(1 for w in words if w[-1] in _SYMBOL_BYTES)
    return np.array(
        [
            np.log1p(n),
            min(30.0, size / n - 1),
            by_class[_UPPER] / letters,
            by_class[_DIGIT] / size,
            by_class[_SYMBOL] / size,
            by_class[_STOP] / n,
            by_class[_COMMA] / n,
            by_class[_BAR] / n,
            by_class[_MARK] / n,
            len(set(words)) / n,
            len(set(lines)) / len(lines),
            np.log1p(n / len(lines)),
            sum(1 for w in words if len(w) == 1) / n,
            (len(pairs) + 1) / n,
            symbol_words / n,
            sum(map(bytes.isupper, words)) / n,
        ]
    )


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and `stats`, an array of doubles, of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float64())
        for batch in batches:
            rows = [text_stats(t).tolist() for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "stats"])

    bound_batches(docs.sparkSession)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, stats array<double>")
