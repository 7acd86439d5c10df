"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are turned by a fixed rotation and cut into halves, and each half has a codebook of
its own. The product of the codebooks is a grid of cells; a vector is stored in the cell of its
nearest codewords. From each vector a multi-sequence traversal visits cells in the order of their
distance, until a distance within which the target share of partners at the threshold lies. What
is stored in visited cells is verified by cosines in double precision.

Equal vectors are one row with a weight from the start. Where a cell holds many vectors, those
within half the threshold's angle of a common centre form a ball: any two of them are linked, by
the triangle inequality, so a group of near copies is one entry whatever its size. Entries are
compared as wholes where their angles and radii decide, and member by member only where they don't.
No pair is written down: tasks return sums of links, and trees of links for the components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import saved
from flowframe.llm.graph import components

COSINE = 0.93
#: Share of partners at the threshold that the traversal must meet from either side.
TARGET_RECALL = 0.999
#: Vectors that codebooks and the traversal's stop are learned from.
MAX_SAMPLE = 8192
#: Vectors of the largest label that a cell should hold on average; it sets the codebooks' size.
CELL_ROWS = 64
MAX_WORDS = 1024
#: Cells of more vectors are searched for balls, on about as many of their rows.
BALL_FROM = 256
BALL_SAMPLE = 512
#: Rows that a task compares at once, from either side.
BLOCK_ROWS = 2048
_MARGIN = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1) if rows else np.empty((0, 0))


def _means(x: np.ndarray, words: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Codewords of the rows: centres that are moved to the mean of the rows nearest to them."""
    centres = x[rng.permutation(len(x))[:words]]
    for _ in range(rounds):
        near = _squares(x, centres).argmin(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(n > 0, total / np.maximum(n, 1), centres)
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, less the row's own square, which doesn't change their order."""
    return (centres * centres).sum(axis=1)[None, :] - 2.0 * (x @ centres.T)


def multi_sequence(first: np.ndarray, second: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Places in two ascending sequences in the order of their sums, as long as these are `most` at most."""
    ahead = [(first[0] + second[0], 0, 0)]
    while ahead:
        total, i, j = heapq.heappop(ahead)
        if total > most:
            return
        yield i, j
        if j + 1 < len(second):
            heapq.heappush(ahead, (first[i] + second[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(ahead, (first[i + 1] + second[0], i + 1, 0))


@dataclass
class Grid:
    """A rotation, the codebooks of both halves, and how far beyond the home cell to go."""

    rotation: np.ndarray
    books: tuple[np.ndarray, np.ndarray]
    stop: float
    angle: float

    def excess(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each half, how much farther each codeword is than the nearest (squared distances)."""
        turned, half = unit @ self.rotation, len(self.rotation) // 2
        d = [_squares(x, b) for x, b in zip((turned[:, :half], turned[:, half:]), self.books, strict=True)]
        return [x - x.min(axis=1, keepdims=True) for x in d]

    def homes(self, excess: list[np.ndarray]) -> np.ndarray:
        return excess[0].argmin(axis=1) * len(self.books[1]) + excess[1].argmin(axis=1)

    def visits(self, excess: list[np.ndarray], radius: np.ndarray) -> list[list[int]]:
        """The cells that each entry visits. A partner of a ball's member may be farther away by
        the ball's radius, and the stop grows in proportion."""
        order = [np.argsort(e, axis=1, kind="stable") for e in excess]
        ranked = [np.take_along_axis(e, o, axis=1) for e, o in zip(excess, order, strict=True)]
        stops = self.stop * np.sin((self.angle + radius) / 2) / np.sin(self.angle / 2)
        wide = len(self.books[1])
        return [
            [int(order[0][r, i]) * wide + int(order[1][r, j]) for i, j in multi_sequence(ranked[0][r], ranked[1][r], stops[r])]
            for r in range(len(stops))
        ]


def learn_grid(sample: np.ndarray, words: int, cosine: float = COSINE, recall: float = TARGET_RECALL, seed: int = 3) -> Grid:
    """Codebooks of up to `words` codewords from unit vectors, and the stop for a target recall.

    The stop is measured: each vector gets a partner at exactly the threshold's angle, in a random
    direction, and the stop is the excess within which that share of partners has its home. The
    rotation makes no direction of real differences special.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    n, d = sample.shape
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
    turned, half = sample @ rotation, d // 2
    books = tuple(_means(x, min(words, n), rng) for x in (turned[:, :half], turned[:, half:]))
    grid = Grid(rotation, books, 0.0, float(np.arccos(cosine)))
    if d < 2:  # of single numbers, partners have the same sign and the same home
        return grid
    side = rng.normal(size=sample.shape)
    side = _unit(side - (side * sample).sum(axis=1, keepdims=True) * sample)
    partner = grid.homes(grid.excess(cosine * sample + np.sqrt(1 - cosine * cosine) * side))
    e = grid.excess(sample)
    there = e[0][np.arange(n), partner // len(books[1])] + e[1][np.arange(n), partner % len(books[1])]
    grid.stop = float(np.quantile(there, recall)) + _MARGIN
    return grid


def _rows(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    named = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named, strict=True)], names=[n for n, _ in named]
    )


def by_id(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id and its vector, a struct `best` of label and v, null where none can have links.

    That is so for null labels, null and zero vectors, those with a null or non-finite component,
    and those of another length than most. Of several rows of one id the least label and vector
    is taken. Rows without an id are left out.
    """
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    fine = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.where(F.col("id").isNotNull()).withColumn("fine", fine)
    sizes = rows.where("fine").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    used = F.col("fine") & (F.size("v") == (sizes["d"] if sizes else 0))
    return rows.groupBy("id").agg(F.min(F.when(used, F.struct("label", "v"))).alias("best"))


def _key(*cols) -> list:
    """Two hashes of equal rows; -0.0 counts as 0.0."""
    flat = F.transform("v", lambda x: x + F.lit(0.0))
    return [F.xxhash64(F.lit(seed), "label", flat).alias(name) for seed, name in ((1, "h1"), (2, "h2"))]


def equal_vectors(rows: DataFrame) -> DataFrame:
    """One row per label and vector: entry (the least id), weight (the number of rows), v in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [np.asarray(x, dtype=np.float64).tobytes() for x in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(v, pa.binary())], names=b.schema.names)

    grouped = rows.select("id", "label", *_key(), "v").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.min("id").alias("entry"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")
    )
    kind = rows.schema["label"].dataType.simpleString()
    return grouped.mapInArrow(run, f"h1 long, h2 long, label {kind}, entry long, weight long, v binary")


def _sample(classes: DataFrame, n: int, most: int) -> np.ndarray:
    """About `most` vectors, those with the least hashes of their ids, as unit vectors."""
    share = min(1.0, 1.5 * most / max(n, 1))
    some = classes.where(F.xxhash64("entry") <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
    return _unit(_vectors(some.orderBy(F.xxhash64("entry"), "entry").limit(most).select("v").toArrow().column("v")))


def _with_homes(classes: DataFrame, grid: Grid, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                home = grid.homes(grid.excess(_unit(_vectors(b.column("v")))))
                yield b.append_column("home", pa.array(home, pa.int32()))

    fields = f"label {kind}, entry long, weight long, v binary"
    return classes.select("label", "entry", "weight", "v").mapInArrow(run, f"{fields}, home int")


def centres(unit: np.ndarray, reach: float) -> np.ndarray:
    """Centres of the groups that hold a twentieth of the rows or more, the largest first: the mean
    of what lies near a row, moved twice."""
    near, found, free = np.cos(min(1.3 * reach, np.pi / 2)), [], np.ones(len(unit), dtype=bool)
    close = unit @ unit.T >= near
    while free.any():
        reached = (close & free).sum(axis=1) * free
        if reached.max() * 20 < len(unit):
            break
        c = unit[reached.argmax()]
        for _ in range(2):
            c = _unit(unit[free & (unit @ c >= near)].sum(axis=0, keepdims=True))[0]
        inside = free & (unit @ c >= np.cos(reach))
        if inside.sum() * 20 < len(unit):
            free[reached.argmax()] = False
            continue
        found.append(c)
        free &= ~inside
    return np.array(found).reshape(-1, unit.shape[1])


def ball_members(homed: DataFrame, reach: float, ball_from: int = BALL_FROM) -> DataFrame:
    """The rows of `homed` with ball (null: on its own), the angle to its centre, and the centre.

    Only cells of more than `ball_from` rows have balls. Their centres come from about
    `BALL_SAMPLE` rows each, so that no cell is gathered; every row of the cell is then held
    against them. Which centres are found changes the cost, never a link.
    """
    kind = homed.schema["label"].dataType.simpleString()
    hot = homed.groupBy("label", "home").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ball_from)
    share = F.lit(float(BALL_SAMPLE)) / F.col("n")
    some = homed.join(hot, ["label", "home"]).where(F.pmod(F.xxhash64(F.lit("ball"), "entry"), F.lit(1 << 20)) < share * (1 << 20))

    def choose(t: pa.Table) -> pa.Table:
        unit = _unit(_vectors(t.column("v")))
        order = np.argsort(t.column("entry").to_numpy(), kind="stable")
        found = centres(unit[order], reach)
        ends = [t.column(c).slice(0, 1).cast(k) for c, k in (("label", t.schema.field("label").type), ("home", pa.int32()))]
        return pa.table({"label": ends[0], "home": ends[1], "balls": pa.array([[c.tobytes() for c in found]], pa.list_(pa.binary()))})

    balls = some.groupBy("label", "home").applyInArrow(choose, f"label {kind}, home int, balls array<binary>")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            unit, given = _unit(_vectors(b.column("v"))), b.column("balls").to_pylist()
            ball, angle, centre = [None] * b.num_rows, [0.0] * b.num_rows, [None] * b.num_rows
            known: dict = {}
            for r, of in enumerate(given):
                if of:
                    known.setdefault(tuple(of), []).append(r)
            for of, rows in known.items():
                c = np.frombuffer(b"".join(of)).reshape(len(of), -1)
                angles = np.arccos(np.clip((unit[rows][:, None, :] * c[None]).sum(axis=2), -1, 1))
                best = angles.argmin(axis=1)
                for at, r in enumerate(rows):
                    a = float(angles[at, best[at]])
                    if a <= reach:
                        ball[r], angle[r], centre[r] = int(best[at]), a, of[best[at]]
            b = b.drop_columns(["balls"])
            b = b.append_column("ball", pa.array(ball, pa.int32()))
            yield b.append_column("angle", pa.array(angle, pa.float64())).append_column("centre", pa.array(centre, pa.binary()))

    joined = homed.select("label", "home", "entry", "weight", "v").join(balls, ["label", "home"], "left")
    return joined.mapInArrow(assign, f"label {kind}, home int, entry long, weight long, v binary, ball int, angle double, centre binary")


def entries(members: DataFrame, grid: Grid) -> DataFrame:
    """Balls and single rows alike, with the cells they visit. A ball is known by its least entry."""
    kind = members.schema["label"].dataType.simpleString()
    single = members.where("ball IS NULL").select("label", "entry", "weight", F.lit(0.0).alias("radius"), "home", "v")
    balls = members.where("ball IS NOT NULL").groupBy("label", "home", "ball").agg(
        F.min("entry").alias("entry"), F.sum("weight").alias("weight"), F.max("angle").alias("radius"), F.first("centre").alias("v")
    )
    both = single.unionByName(balls.select("label", "entry", "weight", "radius", "home", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                cells = grid.visits(grid.excess(_unit(_vectors(part.column("v")))), part.column("radius").to_numpy())
                # members of a ball share a home that need not be its centre's
                cells = [c if h in c else [*c, h] for c, h in zip(cells, part.column("home").to_pylist(), strict=True)]
                yield part.append_column("visits", pa.array(cells, pa.list_(pa.int32())))

    fields = f"label {kind}, entry long, weight long, radius double, home int, v binary"
    return both.mapInArrow(run, f"{fields}, visits array<int>")


def _trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components as the given ones, one for each node at most."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def _at_least(s: np.ndarray, x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Whether cosines reach the threshold. Products of matrices may differ in their last bit with
    the matrices' shape: those next to the threshold are summed anew, each in the same order."""
    linked = s >= cosine
    for i, j in zip(*np.nonzero(np.abs(s - cosine) < _MARGIN), strict=True):
        linked[i, j] = (x[i] * y[j]).sum() >= cosine
    return linked


def _sides(t: pa.Table) -> tuple[pa.Table, pa.Table]:
    here = t.column("here")
    return t.filter(here), t.filter(pc.invert(here))


_FOUND = "kind int, a long, b long"
COUNT, LINK, OPEN = 0, 1, 2


def _summed(ids: np.ndarray, add: np.ndarray, some: np.ndarray) -> list[np.ndarray]:
    return [np.full(int(some.sum()), COUNT), ids[some], add[some].astype(np.int64)]


def compare_entries(listed: DataFrame, grid: Grid, cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """kind, a, b: links that an entry gained (a: entry, b: their number), links of a component,
    and pairs of entries that must be compared member by member.

    A group holds what is stored in a cell and who visits it, in blocks of bounded size. Two
    entries may meet in the home cells of both; then they count where the lesser one is stored.
    """
    stored = listed.select("label", F.col("home").alias("cell"), F.lit(True).alias("here"), "entry", "weight", "radius", "home", "visits", "v")
    visitors = listed.select(
        "label", F.explode("visits").alias("cell"), F.lit(False).alias("here"), "entry", "weight", "radius", "home",
        F.lit(None).cast("array<int>").alias("visits"), "v"
    )
    sizes = stored.select("label", "cell", "here").union(visitors.select("label", "cell", "here")).groupBy("label", "cell").agg(
        F.ceil(F.sum(F.col("here").cast("int")) / block_rows).cast("int").alias("k"),
        F.ceil(F.sum((~F.col("here")).cast("int")) / block_rows).cast("int").alias("l"),
    )
    large = sizes.where("k > 1 OR l > 1")
    own = lambda parts: F.pmod(F.xxhash64(F.lit("block"), "entry"), parts).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), parts - 1))
    sized = lambda df: df.join(large, ["label", "cell"], "left").withColumn("k", F.coalesce("k", F.lit(1))).withColumn("l", F.coalesce("l", F.lit(1)))
    left = sized(stored).withColumn("x", own(F.col("k"))).withColumn("y", every(F.col("l")))
    right = sized(visitors).withColumn("x", every(F.col("k"))).withColumn("y", own(F.col("l")))

    def run(t: pa.Table) -> pa.Table:
        s, p = _sides(t)
        if not len(s) or not len(p):
            return pa.Table.from_batches([_rows(_FOUND, [[], [], []])])
        (si, sw, sr), (pi, pw, pr, ph) = ([x.column(c).to_numpy() for c in names] for x, names in ((s, ("entry", "weight", "radius")), (p, ("entry", "weight", "radius", "home"))))
        sv, pv = _unit(_vectors(s.column("v"))), _unit(_vectors(p.column("v")))
        homes, place = np.unique(ph, return_inverse=True)
        cells = [np.array(c) for c in s.column("visits").to_pylist()]
        flat, owner = np.concatenate(cells), np.repeat(np.arange(len(cells)), [len(c) for c in cells])
        at = np.minimum(np.searchsorted(homes, flat), len(homes) - 1)
        met = np.zeros((len(s), len(homes)), dtype=bool)
        met[owner[homes[at] == flat], at[homes[at] == flat]] = True
        mine = (si[:, None] < pi[None, :]) | ((si[:, None] != pi[None, :]) & ~met[:, place])
        cos = sv @ pv.T
        linked, wide = _at_least(cos, sv, pv, cosine), sr[:, None] + pr[None, :]
        unsure = np.zeros_like(mine)
        if wide.any():
            angle = np.arccos(np.clip(cos, -1.0, 1.0))
            sure = angle + wide <= grid.angle - 1e-7
            unsure = (wide > 0) & mine & ~sure & (angle - wide <= grid.angle + 1e-7)
            linked = np.where(wide > 0, sure, linked)
        linked &= mine
        of_s, of_p = linked @ pw, sw @ linked
        i, j = np.nonzero(linked)
        a, b = _trees(si[i], pi[j])
        k, m = np.nonzero(unsure)
        out = [_summed(si, of_s, of_s > 0), _summed(pi, of_p, of_p > 0), [np.full(len(a), LINK), a, b], [np.full(len(k), OPEN), si[k], pi[m]]]
        return pa.Table.from_batches([_rows(_FOUND, [np.concatenate(c) for c in zip(*out, strict=True)])])

    return left.unionByName(right).drop("k", "l").groupBy("label", "cell", "x", "y").applyInArrow(run, _FOUND)


def compare_members(open_: DataFrame, members: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The links between the members of pairs of entries, as `compare_entries` gives them."""
    balls = members.where("of IS NOT NULL")
    flat = members.select(F.coalesce("of", "entry").alias("of"), "entry", "weight", "v")
    is_ball = balls.select(F.col("of").alias("a")).distinct()
    turned = open_.join(is_ball, "a", "left_semi").select("a", "b").union(
        open_.join(is_ball, "a", "left_anti").select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    others = turned.join(flat.withColumnRenamed("of", "b"), "b").select(F.col("a").alias("of"), "entry", "weight", "v")
    wanted = turned.select(F.col("a").alias("of")).distinct()
    inside = flat.join(wanted, "of", "left_semi")
    count = lambda df, name: df.groupBy("of").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))
    sizes = saved(count(inside, "k").join(count(others, "l"), "of"), "open-sizes")
    own = lambda parts: F.pmod(F.xxhash64(F.lit("member"), "entry"), parts).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), parts - 1))
    left = inside.join(sizes, "of").withColumn("x", own(F.col("k"))).withColumn("y", every(F.col("l"))).withColumn("here", F.lit(True))
    right = others.join(sizes, "of").withColumn("x", every(F.col("k"))).withColumn("y", own(F.col("l"))).withColumn("here", F.lit(False))

    def run(t: pa.Table) -> pa.Table:
        s, p = _sides(t)
        if not len(s) or not len(p):
            return pa.Table.from_batches([_rows(_FOUND, [[], [], []])])
        (si, sw), (pi, pw) = ([x.column(c).to_numpy() for c in ("entry", "weight")] for x in (s, p))
        sv, pv = _unit(_vectors(s.column("v"))), _unit(_vectors(p.column("v")))
        linked = _at_least(sv @ pv.T, sv, pv, cosine)
        of_s, of_p = linked @ pw, sw @ linked
        i, j = np.nonzero(linked)
        a, b = _trees(si[i], pi[j])
        out = [_summed(si, of_s, of_s > 0), _summed(pi, of_p, of_p > 0), [np.full(len(a), LINK), a, b]]
        return pa.Table.from_batches([_rows(_FOUND, [np.concatenate(c) for c in zip(*out, strict=True)])])

    return left.unionByName(right).drop("k", "l").groupBy("of", "x", "y").applyInArrow(run, _FOUND)


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    recall: float = TARGET_RECALL,
    cell_rows: int = CELL_ROWS,
    ball_from: int = BALL_FROM,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per id, and one per row without an id.

    Vectors of equal, non-null labels are linked when their cosine is `cosine` or more. n_links
    counts the other vectors that a vector is linked with, equal ones included. component_id is the
    smallest id that links reach, and kept tells whether that is its own. Null, zero and non-finite
    vectors, those of another length than most, and those without a label link with nothing. So do
    rows without an id: their component is null, and they are kept. Rows that repeat an id are one
    vector, the least of them. An empty table gives no rows; other columns are not read.
    """
    known = saved(by_id(df, id_col, vector_col, label_col), "vectors-by-id")
    rows = known.where("best IS NOT NULL").select("id", "best.label", "best.v")
    placed = rows.select(F.col("id").alias("vec_id"), *_key())
    alone = known.where("best IS NULL").select(F.col("id").alias("vec_id")).unionByName(
        df.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("vec_id"))
    )
    classes = saved(equal_vectors(rows), "vectors")
    kind = rows.schema["label"].dataType.simpleString()
    n = classes.count()
    if n:
        most = classes.groupBy("label").count().agg(F.max("count")).first()[0]
        words = int(min(MAX_WORDS, max(1, round((most / cell_rows) ** 0.5))))
        grid = learn_grid(_sample(classes, n, MAX_SAMPLE), words, cosine, recall)
        reach = grid.angle / 2 - 1e-7
        members = ball_members(saved(_with_homes(classes, grid, kind), "homes"), reach, ball_from)
        members = saved(members, "members")
        listed = saved(entries(members, grid), "entries")
        found = saved(compare_entries(listed, grid, cosine, block_rows), "found")
        balls = members.where("ball IS NOT NULL").groupBy("label", "home", "ball").agg(F.min("entry").alias("of"), F.sum("weight").alias("total"))
        members = saved(members.join(balls, ["label", "home", "ball"], "left").select("entry", "weight", "v", "of", "total"), "balls")
        more = saved(compare_members(found.where(f"kind = {OPEN}").select("a", "b"), members, cosine, block_rows), "found-members")
        sums = lambda f: f.where(f"kind = {COUNT}").groupBy("a").agg(F.sum("b").alias("n"))
        of_entry, of_member = sums(found).withColumnsRenamed({"a": "top", "n": "n_top"}), sums(more).withColumnsRenamed({"a": "entry", "n": "n_own"})
        links = found.where(f"kind = {LINK}").select("a", "b").union(more.where(f"kind = {LINK}").select("a", "b")).union(
            members.where("of IS NOT NULL").select(F.col("of").alias("a"), F.col("entry").alias("b"))
        )
        named = components(links).withColumnRenamed("node", "entry")
        counted = members.withColumn("top", F.coalesce("of", "entry")).join(of_entry, "top", "left").join(of_member, "entry", "left")
        counted = counted.join(named, "entry", "left").select(
            "entry",
            (F.coalesce("total", "weight") - 1 + F.coalesce("n_top", F.lit(0)) + F.coalesce("n_own", F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component", "entry").alias("component_id"),
        )
        verdicts = saved(classes.select("h1", "h2", "entry").join(counted, "entry").drop("entry"), "verdicts")
    else:
        verdicts = df.sparkSession.createDataFrame([], "h1 long, h2 long, n_links long, component_id long")
    linked = placed.join(verdicts, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    every = linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


#: The result as SQL over `embeddings`, from all pairs of a label.
VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
fine AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS least FROM v UNION SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.node WHERE r.least < l.b
), found AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT f.node AS vec_id, coalesce(c.n, 0)::BIGINT AS n_links, f.component_id, f.node = f.component_id AS kept
FROM found f LEFT JOIN counts c ON c.a = f.node
"""
