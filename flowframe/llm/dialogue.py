"""Conversation structure repair by generalised LR parsing.

The roles of a conversation are parsed with the grammar

    talk -> pairs | system pairs | nothing        pairs -> user assistant | pairs user assistant

while rows may be deleted or get another role and missing turns may be inserted, each at a cost.
All parses advance together, row by row: their stacks are one graph of (row, top of the stack),
and stacks with equal tops are merged, as they can only go on alike, by the least (cost, audit). A
row keeps one byte for each top, which edge leads back.

Faults are judged, and rows numbered, by windows. One pass over the numbered rows, without their
texts, finds the repairs; a second one over rows and repairs, in order, feeds the digests. So a
task holds some bytes for each row of the one conversation that it parses, and never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import bound_batches, crc32_sql, saved

#: Characters between words, and those that end a sentence.
SPACES, ENDS = " \t\n\x0b\x0c\r", ".!?"
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
CLEAN, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Tops: 0 nothing, 1 system, 2 a first user, 3 pairs, 4 pairs and a user. An assistant is shifted
#: and its pair reduced at once.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 4, (4, "a"): 3}
TOPS, ACCEPT = 5, (0, 3)
#: What may be inserted at once: no more helps, as two turns make a pair.
MOST_INSERTED = 2
LETTERS = "DKR"
NAMES = {"u": "user", "a": "assistant"}


def _missing(top: int) -> str:
    return "u" if (top, "u") in SHIFT else "a"


def _inserted(top: int) -> Iterator[tuple[int, str]]:
    """The tops that inserts lead to, with the roles inserted."""
    roles = ""
    for _ in range(MOST_INSERTED + 1):
        yield top, roles
        roles += _missing(top)
        top = SHIFT[top, roles[-1]]


#: For each top and role initial: (code, step, cost without TRUNCATED, new top, may be had for a blank or duplicate row).
def _moves(initial: str) -> list[list[tuple[int, str, int, int, bool]]]:
    moves = []
    for top in range(TOPS):
        found = []
        for k, (at, roles) in enumerate(_inserted(top)):
            after = [("D", DELETE, at)]
            if (at, initial) in SHIFT:
                after.append(("K", 0, SHIFT[at, initial]))
            after.append(("R", REROLE, SHIFT[at, _missing(at)]))
            for letter, cost, new in after:
                code = (top * (MOST_INSERTED + 1) + k) * len(LETTERS) + LETTERS.index(letter)
                found.append((code, "I" * len(roles) + letter, cost + INSERT * k, new, letter == "D"))
        moves.append(found)
    return moves


_MOVES = {c: _moves(c) for c in ("s", "u", "a", "")}


class Repair:
    """The graph of stacks over the rows fed so far.

    Audits of different tops never begin with one another, since each ends where the same row was
    used up. So their order is settled when they part, and a rank for each top stands for its audit.
    """

    def __init__(self):
        self.tops = {0: (0, 0)}  # top: (cost, rank of its audit)
        self.back = bytearray()

    def feed(self, initial: str, fault: int) -> None:
        moves = _MOVES.get(initial, _MOVES[""])
        best: dict[int, tuple[int, int, str, int]] = {}
        only_delete, more = fault in (BLANK, DUPLICATE), TRUNCATED if fault == CUT else 0
        for top, (cost, rank) in self.tops.items():
            for code, step, price, new, deletes in moves[top]:
                if deletes or not only_delete:
                    way = (cost + price + (0 if deletes else more), rank, step, code)
                    if new not in best or way < best[new]:
                        best[new] = way
        order = sorted(best, key=lambda t: best[t][1:3])
        self.tops = {t: (best[t][0], i) for i, t in enumerate(order)}
        self.back.extend(best[t][3] if t in best else 255 for t in range(TOPS))

    def finish(self) -> tuple[int, str, list[str]]:
        """The cost, the audit, and for each row (and the end) its edits: roles inserted before it,
        then D, K, or the initial of its new role as a capital."""
        ends = []
        for top, (cost, rank) in self.tops.items():
            for at, roles in _inserted(top):
                if at in ACCEPT:
                    ends.append((cost + INSERT * len(roles), rank, roles, top))
                    break
        cost, _, last, top = min(ends)
        audit, edits = ["I" * len(last)], [last]
        for row in range(len(self.back) // TOPS - 1, -1, -1):
            rest, letter = divmod(self.back[row * TOPS + top], len(LETTERS))
            top, k = divmod(rest, MOST_INSERTED + 1)
            at, roles = list(_inserted(top))[k]
            edits.append(roles + (_missing(at).upper() if LETTERS[letter] == "R" else LETTERS[letter]))
            audit.append("I" * k + LETTERS[letter])
        return cost, "".join(reversed(audit)), edits[::-1]


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copy of the rows after damage by the checksum of their place.

    Nulls are one space, in the checksum's text as well. One row in twenty is dropped, one loses
    its text, one its marks of sentence ends, one comes twice, one is said by the user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(space("text"), ENDS, "")).otherwise(space("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).when(kind != 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(space("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn, role, text and fault of each row.

    Rows are in the order of their turns, nulls first; rows of one turn by role and text. Both
    windows are dealt out by conversation, in one shuffle.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    again = Window.partitionBy("conv_id", "role", "text").orderBy("pos")
    bare = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(bare == "", BLANK)
        .when(F.row_number().over(again) > 1, DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(*ENDS), CUT)
        .otherwise(CLEAN)
    )
    placed = rows.withColumn("pos", F.row_number().over(order).cast("long"))
    return placed.select("conv_id", "pos", "turn", "role", "text", fault.alias("fault"))


_REPAIRS = "conv_id long, pos long, edits string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_KINDS = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 6, pa.string()]
_LOT = 4096


class _Talk:
    """The counts of one conversation, and its repair."""

    def __init__(self, conv: int | None):
        self.conv, self.repair = conv, Repair()
        self.faults, self.illegal, self.said = [0, 0, 0, 0], 0, None
        self.first = self.last = None
        self.turns = 0

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.said is not None and self.said + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.said = initial
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.repair.feed(initial, fault)

    def found(self) -> Iterator[tuple]:
        """One row for the conversation, and one for each place where rows don't stay as they are."""
        cost, audit, edits = self.repair.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        yield (self.conv, None, None, gaps, *self.faults[1:], self.illegal, cost, audit)
        for pos, edit in enumerate(edits, 1):
            if edit not in ("K", ""):
                yield (self.conv, pos, edit, *[None] * 7)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    lot = []
    for r in rows:
        lot.append(r)
        if len(lot) == _LOT:
            yield _batch(lot, names, kinds)
            lot = []
    yield _batch(lot, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows by conversation, in as many partitions as shuffles have: rows without their texts are
    few bytes, but much work, and would be merged into a few tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "conv_id")


def repairs(rows: DataFrame) -> DataFrame:
    """For each conversation its counts, cost and audit (pos is null), and the edits of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            talk = None
            for b in batches:
                for conv, turn, initial, fault in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")), strict=True):
                    if talk is None or talk.conv != conv:
                        if talk is not None:
                            yield from talk.found()
                        talk = _Talk(conv)
                    talk.row(turn, initial, fault)
            if talk is not None:
                yield from talk.found()

        yield from _batches(found(), [x.split()[0] for x in _REPAIRS.split(", ")], _KINDS)

    short = rows.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "fault")
    return _dealt(short).sortWithinPartitions("conv_id", "pos").mapInArrow(run, _REPAIRS)


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id and the digest of its repaired rows, as `role:text` joined by newlines."""
    both = rows.select("conv_id", "pos", F.lit(None).cast("string").alias("edits"), "role", "text").unionByName(
        edits.select("conv_id", "pos", "edits", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines(said: str | None, role: str | None, text: str | None) -> Iterator[str]:
            for c in said or "":
                if c in NAMES:
                    yield f"{NAMES[c]}:"
                elif c in "UA":
                    yield f"{NAMES[c.lower()]}:{text}"
                elif c == "K":
                    yield f"{role}:{text}"
            if said is None and role is not None:
                yield f"{role}:{text}"

        def found() -> Iterator[tuple]:
            conv, digest, pending, begun = None, None, None, False
            for b in batches:
                for c, edit, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "edits", "role", "text")), strict=True):
                    if digest is None or c != conv:
                        if digest is not None:
                            yield conv, _closed(digest, pending, begun)
                        conv, digest, pending, begun = c, hashlib.sha256(), None, False
                    if role is None:  # the edits of the row that follows, or of the end
                        pending = edit
                        continue
                    for line in lines(pending, role, text):
                        digest.update((b"\n" if begun else b"") + line.encode())
                        begun = True
                    pending = None
            if digest is not None:
                yield conv, _closed(digest, pending, begun)

        def _closed(digest, pending: str | None, begun: bool) -> str:
            for line in lines(pending, None, None):
                digest.update((b"\n" if begun else b"") + line.encode())
                begun = True
            return digest.hexdigest()

        yield from _batches(found(), ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()])

    in_order = _dealt(both).sortWithinPartitions("conv_id", "pos", F.col("edits").asc_nulls_last())
    return in_order.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, pos, part, role and text of the repaired conversations: rows that stay, rows with a
    new role, and inserted empty ones, in the order of pos and part. `rows` are those of `judged`."""
    named = edits.select(F.col("conv_id").alias("c"), F.col("pos").alias("p"), "edits").where("pos IS NOT NULL")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pos") == F.col("p"))
    joined = rows.join(named, same, "full").select(
        F.when(F.col("pos").isNull(), F.col("c")).otherwise(F.col("conv_id")).alias("conv_id"),
        F.coalesce("pos", "p").alias("pos"),
        "role",
        "text",
        F.posexplode(F.split(F.coalesce("edits", F.lit("K")), "")).alias("part", "edit"),
    )
    role = F.when(F.lower("edit") == "u", F.lit("user")).when(F.lower("edit") == "a", F.lit("assistant")).otherwise(F.col("role"))
    text = F.when(F.col("edit").isin("u", "a"), F.lit("")).otherwise(F.col("text"))
    return joined.where("edit != 'D'").select("conv_id", "pos", "part", role.alias("role"), text.alias("text"))


def repair_report(conversations: DataFrame, damaged: bool = True) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every
    conv_id, the null one included, after `damage` (or, without it, of the rows as they are).

    A conversation without rows after damage has zeros, an empty audit and the digest of an empty
    text. Roles other than system, user and assistant count by their first character; an empty one
    fits nowhere. Repeated rows are rows of their own, and all but the first are duplicates.
    An empty table gives no rows; other columns are not read.
    """
    bound_batches(conversations.sparkSession)
    given = conversations.select("conv_id", "turn", "role", "text")
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = given.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"), F.lit(0).alias("copy"))
    rows = saved(judged(damage(given) if damaged else plain), "judged-turns")
    found = saved(repairs(rows), "repairs")
    hashed = digests(rows, found.where("pos IS NOT NULL").select("conv_id", "pos", "edits"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [
        given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(),
        found.where("pos IS NULL").select("conv_id", *counts, "audit"),
        hashed,
    ]
    joined = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    merged = joined.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*counts, "audit", "repaired_sha256")])
    return merged.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


#: The report as SQL over `conversations`: the least way to each state of a finite automaton, row by row.
REPAIR_SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '{ENDS}', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM numbered WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM hurt
), judged AS (
  SELECT conv_id, pos, turn, role, text, substr(role, 1, 1) AS initial,
         CASE WHEN bare = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM placed
), shift(x, t, y) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
inserts AS (
  SELECT x, 0 AS k, []::VARCHAR[] AS said, x AS y FROM (VALUES (''), ('s'), ('u'), ('a')) v(x)
  UNION ALL
  SELECT i.x, k + 1, list_append(said, CASE t WHEN 'u' THEN 'user:' ELSE 'assistant:' END), s.y FROM inserts i JOIN shift s ON s.x = i.y AND t <> 's' WHERE k < 3
), moves AS (
  SELECT x, k, said, 'D' AS letter, NULL AS t, y FROM inserts
  UNION ALL SELECT i.x, k, said, 'K', t, s.y FROM inserts i JOIN shift s ON s.x = i.y
  UNION ALL SELECT i.x, k, said, 'R', t, s.y FROM inserts i JOIN shift s ON s.x = i.y AND t <> 's'
), tops AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, '' AS state, {{'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]}} AS best FROM conversations
  UNION ALL
  SELECT p.conv_id, p.pos + 1, m.y, min({{
      'cost': p.best.cost + 3 * m.k + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN letter <> 'D' AND fault = 3 THEN 3 ELSE 0 END,
      'audit': p.best.audit || repeat('I', m.k) || letter,
      'said': list_concat(list_concat(p.best.said, m.said), CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
        ELSE [CASE t WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END)}})
  FROM tops p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.pos = p.pos + 1
    JOIN moves m ON m.x = p.state AND (letter = 'D' OR (fault NOT IN (1, 2) AND (letter = 'R' OR t = initial)))
  GROUP BY p.conv_id, p.pos, m.y
), sizes AS (
  SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM judged GROUP BY conv_id
), beside AS (
  SELECT conv_id, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM judged) GROUP BY conv_id
), ends AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + 3 * k, 'audit': p.best.audit || repeat('I', k), 'said': list_concat(p.best.said, i.said)}}) AS best
  FROM tops p LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM p.conv_id JOIN inserts i ON i.x = p.state AND i.y IN ('', 'a')
  WHERE p.pos = coalesce(s.n, 0) GROUP BY p.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.best.cost::BIGINT AS cost, e.best.audit AS audit,
       sha256(array_to_string(e.best.said, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN beside b ON b.conv_id IS NOT DISTINCT FROM e.conv_id
"""
