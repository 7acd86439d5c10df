"""Near-duplicate texts by a blocked sparse product of documents and n-grams.

Two texts are linked when the Jaccard similarity of their word n-gram sets reaches a threshold.
Rows of the incidence matrix are classes of equal sets. Its columns are ordered by how frequent
an n-gram is, rare first, and size-derived bounds say how many of a row's first columns can hold
the first common n-gram of a link: only these enter the product. Columns are dealt out in blocks
by n-gram; a pair that meets in one is dropped when what lies behind that n-gram can't make up
the overlap its sizes ask for. The rest are counted exactly on the whole sets.

Large groups of near copies need no product of all their pairs: each column first links its rows
to one of them, and only columns whose rows are still in different components are multiplied out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import bound_batches, named_back, numbered, saved
from flowframe.llm.graph import components

WORDS = 4
PERCENT = 85
#: Counters of the frequency sketch. Frequencies decide the order of columns, never a result.
SKETCH_BITS = 20
#: Bits of the filters that keep n-grams and rows without a partner out of shuffles.
FILTER_BITS = 24
#: Rows of one column that are multiplied out together; larger columns are cut into such blocks.
COLUMN_ROWS = 512
PIVOT_ROUNDS = 2
#: Partitions of sketches or filters that one task joins.
FAN = 4
_CHUNK = 1 << 19
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _MUL, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of the buffer, in pieces that end between words."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        buf = np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)
        inside = np.concatenate(([False], ~_SPACE[buf], [False]))
        begin, stop = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
        if len(begin):
            length = stop - begin
            letters = buf[inside[1:-1]].astype(np.uint64) + np.uint64(1)
            first = np.cumsum(length) - length
            place = np.arange(len(letters)) - np.repeat(first, length)
            values = np.add.reduceat(letters * _powers(int(length.max()))[place], first)
            hashes.append(mix64(values + length.astype(np.uint64) * _MUL))
            starts.append(begin + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def gram_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text; ASCII letters are lower-cased.

    A text of fewer words has its whole sequence as its one n-gram, a text without words none.
    """
    group, size = [], 0
    for at, t in enumerate(texts, 1):
        group.append((t or "").encode("utf-8", "replace").lower())
        size += len(group[-1])
        if at == len(texts) or size >= _CHUNK:
            bounds = np.concatenate(([0], np.cumsum([len(g) + 1 for g in group])))
            h, starts = word_hashes(b"\n".join(group))
            cut = np.searchsorted(starts, bounds)
            rolled = h
            for k in range(1, words):  # at i: the words from i on, as far as they reach
                rolled = rolled[: max(0, len(h) - k)] * _MUL + h[k:]
            rolled = mix64(rolled)
            for i in range(len(group)):
                lo, hi = cut[i], cut[i + 1]
                if hi - lo >= words:
                    yield np.unique(rolled[lo : hi - words + 1])
                elif hi > lo:
                    whole = np.array([hi - lo], dtype=np.uint64)
                    for x in h[lo:hi]:
                        whole = mix64(whole * _MUL + x)
                    yield whole
                else:
                    yield np.empty(0, np.uint64)
            group, size = [], 0


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for i in range(0, batch.num_rows, 1024):
        part = batch.slice(i, 1024)
        yield from zip(part.column(0).to_pylist(), gram_sets(part.column(1).to_pylist(), words), strict=True)


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _bucket(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def described(docs: DataFrame, words: int = WORDS, bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n, digest of each row's set, and one row of `counts` per task with its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["doc_id", "n", "digest", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        counts = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            rows = []
            for doc, s in _sets(batch, words):
                rows.append((doc, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), None))
                np.add.at(counts, _bucket(s, bits), 1)
            yield _rows(names, types, rows)
        yield _rows(names, types, [(None, -1, None, zlib.compress(counts.tobytes(), 1))])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, counts binary")


def _merged(df: DataFrame, column: str, dtype, join: Callable) -> np.ndarray | None:
    """One array from compressed arrays of fixed size, joined in a tree of tasks.

    A task reads the arrays of some neighbouring partitions, and a level of the tree is written to the
    shared folder, so arrays pass no shuffle and the driver gets a few. `df` is read once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0):
                part = np.frombuffer(zlib.decompress(x.as_py()), dtype=dtype)
                total = part if total is None else join(total, part)
        if total is not None:
            yield _rows([column], [pa.binary()], [(zlib.compress(total.tobytes(), 1),)])

    parts, n = df.where(F.col(column).isNotNull()).select(column), None
    while n is None or n > 2 * FAN:
        n = max(1, -(-parts.rdd.getNumPartitions() // FAN))
        parts = saved(parts.coalesce(n).mapInArrow(run, f"{column} binary"), "merged")
    found = [np.frombuffer(zlib.decompress(r[0]), dtype=dtype) for r in parts.collect()]
    return reduce(join, found) if found else None


def hashed_filter(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit per hash of the column's numbers: what isn't in it isn't in the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << bits, dtype=bool)
        for b in batches:
            out[_filter_at(b.column(0).to_numpy(), bits)] = True
        yield _rows(["bits"], [pa.binary()], [(zlib.compress(np.packbits(out).tobytes(), 1),)])

    made = saved(df.select(F.col(column).cast("long")).mapInArrow(run, "bits binary"), "filters")
    found = _merged(made, "bits", np.uint8, np.bitwise_or)
    return np.zeros(1 << (bits - 3), dtype=np.uint8) if found is None else found


def _filter_at(numbers: np.ndarray, bits: int) -> np.ndarray:
    return _bucket(mix64(numbers.astype(np.int64).view(np.uint64) + _MUL), bits)


def _in_filter(numbers: np.ndarray, packed: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    at = _filter_at(numbers, bits)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def needed(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of two sets of these sizes with a similarity of `percent`."""
    total = (a + b) * percent
    return ((total + F.lit(99 + percent)) / F.lit(100 + percent)).cast("long")


def first_columns(docs: DataFrame, levels: np.ndarray, words: int, percent: int, bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n and the row's first columns in the global order, as a binary of n-gram hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, s in _sets(batch, words):
                n = len(s)
                if not n:
                    continue
                order = np.argsort((levels[_bucket(s, bits)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8)), kind="stable")
                rows.append((doc, n, s[order[: n - -(-percent * n // 100) + 1]].tobytes()))
            yield _rows(["doc_id", "n", "grams"], [pa.int64(), pa.int64(), pa.binary()], rows)

    return docs.mapInArrow(run, "doc_id long, n long, grams binary")


def entries(firsts: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """gram, cls, n, pos of the first columns; with a filter, only of n-grams that it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                b = whole.slice(i, 2048)
                ids, sizes = b.column(0).to_numpy(), b.column(1).to_numpy()
                sets = [np.frombuffer(x.as_py(), dtype=np.int64) for x in b.column(2)]
                if not sets:
                    continue
                count = np.array([len(s) for s in sets])
                grams = np.concatenate(sets)
                pos = np.arange(len(grams)) - np.repeat(np.cumsum(count) - count, count)
                row = np.repeat(np.arange(len(sets)), count)
                keep = slice(None) if only is None else _in_filter(grams, only)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (grams[keep], ids[row[keep]], sizes[row[keep]], pos[keep])], names=["gram", "cls", "n", "pos"]
                )

    return firsts.select("doc_id", "n", "grams").mapInArrow(run, "gram long, cls long, n long, pos long")


def _can_link(a: str, b: str, percent: int) -> Column:
    """Whether two entries of a column can be the first common n-gram of a link.

    With this one and all behind it the overlap must suffice. Of a link's first common n-gram that
    is true, so dropping the others loses no link.
    """
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (most >= needed(na, nb, percent))


def _with_binaries(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b and the binaries x and y of both; `sets` has id and grams."""
    first = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a")
    return first.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b").select("a", "b", "x", "y")


def _kept_pairs(df: DataFrame, keep: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3), strict=True)
            good = [keep(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in both]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, "a long, b long")


def plausible(firsts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose first columns have enough in common.

    Common n-grams are first columns of both, or lie behind all first columns of one of the two.
    The overlap counted on the first columns, and all that lies behind, must reach what the sizes
    ask for; chance meetings in one rare n-gram don't.
    """
    pairs = saved(pairs, "pairs")
    ids = hashed_filter(pairs.select("a").union(pairs.select("b")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_in_filter(batch.column(0).to_numpy(), ids)))
            sized = [np.array([n], "<u8").tobytes() + g for n, g in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sized, pa.binary())], names=["id", "grams"])

    def keep(x: np.ndarray, y: np.ndarray) -> bool:
        a, b = int(x[0]), int(y[0])
        behind = max(a - len(x) + 1, b - len(y) + 1)
        common = len(np.intersect1d(x[1:], y[1:], assume_unique=True))
        return (common + behind) * (100 + percent) >= percent * (a + b)

    sets = firsts.mapInArrow(run, "id long, grams binary")
    return saved(_kept_pairs(_with_binaries(pairs, sets), keep), "plausible")


def verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose whole sets are similar enough.

    Sets are made anew for the texts that a filter of the pairs' ids may hold, and meet their
    pairs in joins on the id.
    """
    if pairs.isEmpty():
        return pairs
    ids = hashed_filter(pairs.select("a").union(pairs.select("b")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            batch = batch.filter(pa.array(_in_filter(batch.column(0).to_numpy(), ids)))
            rows = []
            for doc, s in _sets(batch, words):
                rows.append((doc, s.tobytes()))
                if len(rows) == 512:
                    yield _rows(["id", "grams"], [pa.int64(), pa.binary()], rows)
                    rows = []
            if rows:
                yield _rows(["id", "grams"], [pa.int64(), pa.binary()], rows)

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    sets = docs.mapInArrow(run, "id long, grams binary")
    return saved(_kept_pairs(_with_binaries(pairs, sets), similar).distinct(), "links")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`.

    component_id is the smallest doc_id that links reach. Null, empty and wordless texts have no
    n-grams and no links. Rows without an id have none either, and a null component. Rows that
    repeat an id are one document: links of each of their texts join it. Columns other than doc_id
    and text are not read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = saved(described(docs, words), "described", compression="zstd")
    rows = seen.where("n >= 0").select("doc_id", "n", "digest")
    classes = saved(
        rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("cls")), "classes"
    )
    most = np.uint64(2**32 - 1)
    counts = _merged(seen, "counts", np.uint32, lambda a, b: np.minimum(a + b.astype(np.uint64), most).astype(np.uint32))
    levels = np.zeros(1 << SKETCH_BITS, np.uint8) if counts is None else (2 * np.log2(counts + 1.0)).astype(np.uint8)
    firsts = first_columns(docs.where("doc_id IS NOT NULL"), levels, words, percent)
    firsts = saved(firsts.join(classes.select(F.col("cls").alias("doc_id")).distinct(), "doc_id", "left_semi"), "firsts")
    shared = saved(
        entries(firsts).groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "shared"
    )
    matrix = saved(entries(firsts, hashed_filter(shared, "gram")).join(shared, "gram"), "matrix")

    labels = None
    for turn in range(PIVOT_ROUNDS):
        open_ = _open_columns(matrix, labels)
        order = F.struct("pos", "cls", "n") if not turn else F.struct(F.xxhash64(F.lit(turn), "cls").alias("h"), "cls", "n", "pos")
        pivot = open_.groupBy("gram").agg(F.min(order).alias("p")).select("gram", F.col("p.cls").alias("cls"), F.col("p.n").alias("n"), F.col("p.pos").alias("pos"))
        if labels is not None:
            pivot = pivot.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        pairs = open_.alias("x").join(pivot.alias("p"), F.col("x.gram") == F.col("p.gram")).where(
            (F.col("x.cls") != F.col("p.cls")) & _can_link("x", "p", percent)
        )
        if labels is not None:
            pairs = pairs.where("x.comp != p.comp")
        pairs = pairs.select(F.least("x.cls", "p.cls").alias("a"), F.greatest("x.cls", "p.cls").alias("b")).distinct()
        links = _joined_links(labels, verified(docs, plausible(firsts, pairs, percent), words, percent))
        labels = saved(components(links).select(F.col("node").alias("cls"), F.col("component").alias("comp")), "labels")
    rest = plausible(firsts, _remaining_pairs(_open_columns(matrix, labels), percent), percent)
    links = _joined_links(labels, verified(docs, rest, words, percent))
    found = saved(components(links), "components")
    classed = rows.join(classes, "digest", "left").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "cls")).otherwise(F.col("doc_id"))
    return classed.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
    )


def _joined_links(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """New links, and one from each class linked before to the least of its component."""
    return links if labels is None else labels.select(F.col("cls").alias("a"), F.col("comp").alias("b")).union(links)


def _open_columns(matrix: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The entries of columns whose rows are not all in one component, with their components."""
    if labels is None:
        return matrix.withColumn("comp", F.col("cls"))
    labelled = matrix.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    labelled = saved(labelled.select("gram", "cls", "n", "pos", "k", "comp"), "labelled")
    split = labelled.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    return saved(labelled.join(split.select("gram"), "gram", "left_semi"), "open")


def _remaining_pairs(open_: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet in an open column and may be linked.

    A column of many rows is cut into blocks by hashed class; each pair of its blocks is a group
    of its own, so no group holds more rows than two blocks.
    """
    cuts = F.ceil(F.col("k") / F.lit(COLUMN_ROWS)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), "cls"), cuts).cast("int")
    others = F.sequence(F.lit(0), cuts - 1)
    dealt = open_.withColumn("own", own).withColumn("other", F.explode(others))
    dealt = dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    x, y = dealt.alias("x"), dealt.alias("y")
    meet = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.lo") == F.col("y.lo")) & (F.col("x.hi") == F.col("y.hi"))
    pairs = x.join(y, meet).where(
        (F.col("x.cls") < F.col("y.cls")) & (F.col("x.comp") != F.col("y.comp")) & _can_link("x", "y", percent)
    )
    return pairs.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row for each component, that of the smallest doc_id; columns stay as they are.

    Rows are told apart by id and text: of different texts under one id each is a document of its
    own, and so is a row without an id, which counts behind all others. Rows that repeat id and
    text are one document, of which the least row stays. Rows without n-grams are no component of others.
    Only ids and hashes are gathered; texts pass by in a join.
    """
    used = ("doc_id", "text")
    given = numbered(docs, *used).withColumn("_t", F.xxhash64(F.col("text").cast("string")))
    doc = F.col("doc_id").cast("long")
    texts = given.where("doc_id IS NOT NULL").groupBy(doc.alias("_doc")).agg(F.min("_t").alias("_least"), F.max("_t").alias("_most"))
    several = saved(texts.where("_least != _most").select("_doc", "_least"), "several-texts")
    # a number below zero where the id doesn't tell the row
    hashed = -F.lit(1).cast("long") - F.xxhash64("doc_id", "_t").bitwiseAND(F.lit(2**63 - 1))
    if several.isEmpty():  # each id has one text, as is usual: texts need not pass a join to know it
        nodes = given.withColumn("_node", F.coalesce(doc, hashed))
    else:
        own = given.join(several, doc == F.col("_doc"), "left")
        node = F.when(doc.isNotNull() & (F.col("_least").isNull() | (F.col("_least") == F.col("_t"))), doc).otherwise(hashed)
        nodes = saved(own.withColumn("_node", node).drop("_doc", "_least"), "text-nodes")
    found = near_duplicates(nodes.select(F.col("_node").alias("doc_id"), "text"), words, percent).distinct()
    ids = nodes.select("_node", doc.alias("_id")).groupBy("_node").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    placed = ids.join(found.select(F.col("doc_id").alias("_node"), "component_id").distinct(), "_node")
    best = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_node")).alias("best")
    first = placed.groupBy("component_id").agg(best).select(F.col("best._node").alias("_node"), F.lit(True).alias("_first"))
    verdicts = saved(
        ids.join(first, "_node", "left").where("_n > 1 OR _first IS NULL").select(F.col("_node").alias("_key"), "_n", "_first"), "verdicts"
    )
    joined = nodes.join(verdicts, F.col("_node") == F.col("_key"), "left")
    single = joined.where(F.col("_key").isNull())
    order = Window.partitionBy("_node").orderBy(*[c for c in given.columns if c not in ("doc_id", "text", "_t")], F.lit(0))
    several = joined.where("_n > 1 AND _first").withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")
    return named_back(single.unionByName(several), docs, *used)
