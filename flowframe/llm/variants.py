"""Spelling variants by Bloom-guided neighbourhoods.

Words are counted over all texts. Each word's edits are generated and probed against Bloom filters
of the whole vocabulary, one for each length, which every task holds; they have a bounded size
whatever the vocabulary's. Only edits that a filter may hold are written down as text, and a
join with the vocabulary removes those that are no words.

A filter is blocked: all bits of a word lie in one block of 512. Edits are hashed without being
spelled out: a word's hash is a polynomial, and an edit changes few of its terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import crc32_sql, saved

#: Runs of these are words before damage.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS = 6
MIN_COUNT = 5
#: A form occurs this many times as often as its variant.
TIMES = 5
DAMAGE = 199
#: Lengths from here on share a filter.
LAST_SHARD = 40
BITS_PER_WORD = 20
PROBES = 6
BLOCK_BITS = 512
#: Bytes of all filters together. Beyond it they hold fewer bits a word, and more edits are joined in vain.
MAX_FILTER_BYTES = 1 << 24
#: Letters whose edits are probed at once.
_CHUNK = 1 << 14
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, without one letter where its checksum with the id asks for that; a null id is an empty text."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DAMAGE == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of the words of at least six letters with at least five occurrences.

    Shorter runs can't become words, as damage only takes letters away.
    """
    lower = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    run = F.explode(F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{MIN_LETTERS},}}"), F.lit(0)))
    words = docs.select("doc_id", run.alias("run")).select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= MIN_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


@dataclass
class Spelled:
    """Words as flat arrays of letters: each letter's word, place, power and the sum before it."""

    words: list[str]

    def __post_init__(self):
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.letter = np.frombuffer("".join(self.words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        self.word = np.repeat(np.arange(len(self.words)), self.size)
        first = np.cumsum(self.size) - self.size
        self.place = np.arange(len(self.letter)) - first[self.word]
        powers = np.full(max(1, int(self.size.max(initial=1))), _P, dtype=np.uint64)
        powers[0] = 1
        self.power = np.multiply.accumulate(powers)[self.place]
        ends = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.letter * self.power, dtype=np.uint64)))
        self.before = ends[:-1] - ends[first][self.word]
        self.sum = ends[first + self.size] - ends[first]


def _finished(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    return _mix(total + size.astype(np.uint64) * _C1)


def _shard(size: np.ndarray) -> np.ndarray:
    return np.minimum(size, LAST_SHARD)


class Filters:
    """The blocked Bloom filters of all lengths, in one array of bits."""

    def __init__(self, first: np.ndarray, blocks: np.ndarray, bits: np.ndarray):
        self.first, self.blocks, self.bits = first, blocks, bits

    @classmethod
    def sized(cls, counts: dict[int, int], most_bytes: int = MAX_FILTER_BYTES) -> Filters:
        """Empty filters for so many words of each length; a length without words has no block."""
        words = np.array([counts.get(i, 0) for i in range(LAST_SHARD + 1)], dtype=np.float64)
        share = min(1.0, (most_bytes * 8 - BLOCK_BITS * len(words)) / max(1.0, words.sum() * BITS_PER_WORD))
        blocks = np.maximum(np.ceil(words * BITS_PER_WORD * share / BLOCK_BITS), words > 0).astype(np.int64)
        return cls(np.cumsum(blocks) - blocks, blocks, np.zeros(int(blocks.sum()) * BLOCK_BITS // 8, dtype=np.uint8))

    def _block(self, h: np.ndarray, shard: np.ndarray) -> np.ndarray:
        high = (h >> np.uint64(32)).astype(np.uint64)
        return self.first[shard] + ((high * self.blocks[shard].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def _bit(h: np.ndarray, probe: int) -> np.ndarray:
        return ((_mix(h + np.uint64(1)) >> np.uint64(9 * probe)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)

    def add(self, h: np.ndarray, shard: np.ndarray) -> None:
        start = self._block(h, shard) * BLOCK_BITS
        for k in range(PROBES):
            at = start + self._bit(h, k)
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def may_hold(self, h: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """The places of the hashes that the filters may hold."""
        left = np.flatnonzero(self.blocks[shard] > 0)
        start = self._block(h[left], shard[left]) * BLOCK_BITS
        for k in range(PROBES):
            at = start + self._bit(h[left], k)
            keep = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            left, start = left[keep], start[keep]
        return left


def build_filters(words: DataFrame, most_bytes: int = MAX_FILTER_BYTES) -> tuple[Filters, list[int]]:
    """The filters of a vocabulary, and the letters it is written in. Tasks fill filters of their
    own, which are joined in a tree, so no words come to the driver."""
    lengths = words.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("size")).count()
    empty = Filters.sized({r["size"]: r["count"] for r in lengths.collect()}, most_bytes)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(empty.first, empty.blocks, np.zeros_like(empty.bits))
        letters = np.zeros(256, dtype=np.uint8)
        for b in batches:
            x = Spelled(b.column(0).to_pylist())
            own.add(_finished(x.sum, x.size), _shard(x.size))
            letters[x.letter.astype(np.int64)] = 1
        yield pa.RecordBatch.from_arrays([pa.array([letters.tobytes() + own.bits.tobytes()], pa.binary())], names=["bits"])

    parts = words.select("word").mapInArrow(fill, "bits binary").rdd.map(lambda r: np.frombuffer(r[0], dtype=np.uint8))
    both = parts.treeReduce(np.bitwise_or, depth=3)
    return Filters(empty.first, empty.blocks, both[256:].copy()), [int(c) for c in np.flatnonzero(both[:256])]


def _runs(words: list[str]) -> Iterator[list[str]]:
    """The words in lots of a bounded number of letters, one word at least."""
    lot, size = [], 0
    for w in words:
        lot.append(w)
        size += len(w)
        if size >= _CHUNK:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def likely_edits(words: list[str], filters: Filters, letters: list[int]) -> Iterator[tuple[str, str]]:
    """(word, edit) for every edit that the filters may hold.

    Every pair of words one edit apart comes from one of the two: the longer one loses a letter,
    or the one with the lesser letter gets the greater. Letters lost from a row of equal ones
    give one edit.
    """
    for lot in _runs(words):
        x = Spelled(lot)
        same = np.zeros(len(x.letter), dtype=bool)
        same[1:] = (x.letter[1:] == x.letter[:-1]) & (x.place[1:] > 0)
        at = np.flatnonzero(~same)
        w = x.word[at]
        behind = x.sum[w] - x.before[at] - x.letter[at] * x.power[at]
        size = x.size[w] - 1
        for r in filters.may_hold(_finished(x.before[at] + behind * _INVERSE, size), _shard(size)):
            word, i = lot[w[r]], int(x.place[at[r]])
            yield word, word[:i] + word[i + 1 :]
        for c in letters:
            at = np.flatnonzero(x.letter < c)
            w = x.word[at]
            h = _finished(x.sum[w] + (np.uint64(c) - x.letter[at]) * x.power[at], x.size[w])
            for r in filters.may_hold(h, _shard(x.size[w])):
                word, i = lot[w[r]], int(x.place[at[r]])
                yield word, word[:i] + chr(c) + word[i + 1 :]


def near_words(words: DataFrame, most_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """word, other and other_n: the words one edit apart, both ways, each pair once."""
    filters, letters = build_filters(words, most_bytes)
    shared = words.sparkSession.sparkContext.broadcast((filters.first, filters.blocks, filters.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filters(*shared.value)
        for b in batches:
            spelled, n = b.column(0).to_pylist(), dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            out, size = [], 0
            for word, edit in likely_edits(spelled, held, letters):
                out.append((edit, word, n[word]))
                size += len(word)
                if size >= 1 << 20:
                    yield _edits(out)
                    out, size = [], 0
            yield _edits(out)

    likely = words.select("word", "n").mapInArrow(run, "word string, other string, other_n long")
    real = saved(likely.join(words.select("word", "n"), "word"), "near-words")
    back = real.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return real.select("word", "other", "other_n").union(back)


def _edits(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "other", "other_n"])


def roots(forms: DataFrame) -> DataFrame:
    """word and root: where a chain of forms ends. `forms` has word and form, for words that have one.

    Each round doubles the steps that are taken. Along a chain counts grow fivefold, so chains
    are short, and rounds are few, whatever the vocabulary's size.
    """
    reached = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = reached.join(on, reached["root"] == on["at"], "left")
        after = saved(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = after.select("word", "root")
        if after.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, most_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of `docs` (doc_id, text).

    Words are maximal runs of letters (ASCII and U+00C0 to U+00FF), ASCII lower-cased and damaged
    as `damaged` says, of at least six letters and with five occurrences. n_near counts the words
    one inserted, deleted or replaced letter away. The most frequent of them (ties: the least) is a
    word's form if it occurs at least five times as often as the word. Null and empty texts have no
    words; an empty table gives no rows; repeated rows count as often as they stand there. Columns
    other than doc_id and text are not read.
    """
    words = saved(vocabulary(docs.select("doc_id", "text")), "vocabulary")
    if words.isEmpty():
        return words.select("word", *[F.lit(None).cast("string").alias(c) for c in ("form", "root")], "n", *[F.lit(0).cast("long").alias(c) for c in ("n_near", "form_n")])
    near = near_words(words, most_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    most = -F.col("best.less")
    frequent = most >= TIMES * F.col("n")
    judged = saved(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.other")).alias("form"),
            F.when(frequent, most).alias("form_n"),
        ),
        "judged-words",
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The result as SQL over `documents`: words meet by their shortened spellings.
VARIANTS_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]{{6,}}')) AS run FROM documents
), summed AS (
  SELECT run, count(*) AS k, coalesce(doc_id::VARCHAR, '') || ':' || run AS named FROM runs GROUP BY run, doc_id
), hashed AS (
  SELECT run, k, {crc32_sql('named')} AS h FROM summed
), spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), short AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other FROM short a JOIN short b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word FROM short s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM short s JOIN words w ON w.word = s.rest
), near AS (
  SELECT p.word, count(*) AS n_near, min((-o.n, o.word)) AS best FROM pairs p JOIN words o ON o.word = p.other GROUP BY p.word
), judged AS (
  SELECT w.word, w.n, coalesce(x.n_near, 0)::BIGINT AS n_near, CASE WHEN -x.best[1] >= 5 * w.n THEN x.best[2] END AS form,
         CASE WHEN -x.best[1] >= 5 * w.n THEN -x.best[1] END AS form_n FROM words w LEFT JOIN near x ON x.word = w.word
), up AS (
  SELECT word, word AS root FROM judged UNION ALL SELECT u.word, j.form FROM up u JOIN judged j ON j.word = u.root WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, u.root, j.n, j.n_near, j.form_n::BIGINT AS form_n
FROM judged j JOIN up u ON u.word = j.word JOIN judged t ON t.word = u.root WHERE t.form IS NULL
"""
