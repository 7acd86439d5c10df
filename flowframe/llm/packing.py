"""Packing: documents' tokens in one long row, cut into sequences of a fixed length.

Pass one tokenises and writes each partition's tokens with their offsets in the partition. The
totals of the partitions give each partition's first global offset. Pass two cuts the documents
at the multiples of the sequence length; a document on a border is in two or more pieces.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowframe.llm.common import bound_batches, saved, texts

SEQUENCE = 2048
END_ID = 1
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"
)
_TOKENS = "part int, doc_id long, start long, n_tokens long, ids binary"
#: Texts of these characters alone are split alike by both libraries, whatever Unicode version they hold.
_PLAIN = re.compile(r"[^\x00-ɏ]")


@lru_cache(maxsize=2)
def _whole_tokenizer(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


@lru_cache(maxsize=2)
def _tokenizer(name: str) -> Callable[[list[str]], list[list[int]]]:
    """A function from texts to lists of ids, those of the tokenizers file.

    The same vocabulary as a rank table encodes several times faster. It is used where both are
    sure to agree: Latin texts that hold none of the file's special tokens. The file itself is
    loaded when a text asks for it, since workers keep it in memory.
    """
    if name != "byte_bpe_50k.json":
        return lambda batch: [e.ids for e in _whole_tokenizer(name).encode_batch(batch, add_special_tokens=False)]
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> list[int]:
        if _PLAIN.search(text) or any(s in text for s in special):
            return _whole_tokenizer(name).encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return lambda batch: [ids(t) for t in batch]


def tokenize(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID) -> DataFrame:
    """part, doc_id, start, n_tokens, ids of each row: `start` counts the partition's ids before it.

    `ids` holds unsigned little-endian 16-bit numbers where the vocabulary allows, else 32-bit. A
    null text has the end id alone. Column names other than doc_id and text don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = _tokenizer(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                rows = [np.array([*ids, end_id], dtype="<u4") for ids in encode(texts(batch.column(1)))]
                n = np.array([len(r) for r in rows], dtype=np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), part, dtype=np.int32)),
                        batch.column(0).cast(pa.int64()),
                        pa.array(starts),
                        pa.array(n),
                        pa.array([_packed(r) for r in rows], pa.binary()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _TOKENS)


def _packed(ids: np.ndarray) -> bytes:
    """A byte for the width, then the ids."""
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 65536 else b"\4" + ids.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype("<u4")


def pack(
    docs: DataFrame, sequence: int = SEQUENCE, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID
) -> DataFrame:
    """One row per piece; see PIECES.

    `start` counts the document's ids before the piece, `offset` the sequence's. All sequences
    are full but the last; `padded_length` says how long each one is with padding, which a
    sequence of a power of two goes without. Every row of `docs` is packed, also repeated ones
    and those without text or id; an empty table gives no rows.

    Documents keep the order of the table's partitions. What reaches the driver is one number per
    written partition, and no row is shuffled: tokens stay in the table written by pass one.
    """
    bound_batches(docs.sparkSession)
    tokens = saved(tokenize(docs, tokenizer, end_id), "tokens", compression="zstd")
    totals = sorted(tokens.groupBy("part").agg(F.sum("n_tokens")).toLocalIterator())
    parts = np.array([p for p, _ in totals], dtype=np.int64)
    sums = np.array([n for _, n in totals], dtype=np.int64)
    firsts, total = np.cumsum(sums) - sums, int(sums.sum())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = firsts[np.searchsorted(parts, batch.column(0).to_numpy())] + batch.column(2).to_numpy()
            docs_, n, ids = batch.column(1), batch.column(3).to_numpy(), batch.column(4)
            end = begin + n
            first_seq, last_seq = begin // sequence, (end - 1) // sequence
            counts = last_seq - first_seq + 1
            row = np.repeat(np.arange(len(n)), counts)
            seq = first_seq[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            lo, hi = np.maximum(begin[row], seq * sequence), np.minimum(end[row], (seq + 1) * sequence)
            crc = np.empty(len(row), dtype=np.int64)
            held, at = np.empty(0, dtype="<u4"), -1
            for k, r in enumerate(row):
                if r != at:
                    held, at = _unpacked(ids[int(r)].as_py()), r
                crc[k] = zlib.crc32(held[lo[k] - begin[r] : hi[k] - begin[r]].tobytes())
            used = np.minimum(total - seq * sequence, sequence)
            yield pa.RecordBatch.from_arrays(
                [
                    docs_.take(pa.array(row)),
                    pa.array(lo - begin[row]),
                    pa.array(hi - lo),
                    pa.array(crc),
                    pa.array(n[row]),
                    pa.array(seq),
                    pa.array(lo - seq * sequence),
                    pa.array(np.where(used & (used - 1), sequence, used)),
                ],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    return tokens.mapInArrow(cut, PIECES)
