"""Line dedup by a segment-partition edit join, in DataFrame expressions alone.

Lines are cut into segments, at places that their lengths decide, and edits leave some of them
equal: with a threshold of two, two of four; with one, all but one of four quarters; with more, one of
threshold + 1. Substrings of a line are probed against the segments of lines that are as long or
a little shorter. Candidates are verified by a banded bit-parallel edit distance: a word of
2 * threshold + 1 bits goes along the diagonal, one letter at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import WORD, named_back, numbered, saved

EDITS = 2
#: Letters that are counted to tell candidates apart before they meet.
LETTERS = " eantiosrludch"
#: Lines of fewer characters are left as they are.
MIN_CHARS = 20


def _start(length: Column, i: int, parts: int) -> Column:
    """Where segment i of `parts` begins (from 0); the last segments take what doesn't divide."""
    return (length / parts).cast("int") * i + F.greatest(F.lit(0), length % parts - (parts - i))


def _size(length: Column, i: int, parts: int) -> Column:
    return (length / parts).cast("int") + F.when(length % parts >= parts - i, 1).otherwise(0)


def _key(line: Column, length: Column, i: int, shift: int, parts: int) -> Column:
    """The hash of the substring that stands for segment i of a line of this length."""
    part = F.substring(line, _start(length, i, parts) + F.lit(1 + shift), _size(length, i, parts))
    return F.xxhash64(length.cast("int"), F.lit(i), part)


def _key_around(line: Column, length: Column, q: int, less: int) -> Column:
    """The hash of all that lies before and behind quarter q of a line of this length, in a line
    that is longer by `less`."""
    begin, end = _start(length, q, 4), _start(length, q, 4) + _size(length, q, 4)
    before = F.substring(line, F.lit(1), begin)
    return F.xxhash64(length.cast("int"), F.lit(q), before, F.substring(line, end + F.lit(1 + less), length - end))


def _rung(n: Column) -> Column:
    """The largest step that is n at most: lengths below 64 have one in four, others one in sixteen."""
    return F.when(n < 64, n - n % 4).otherwise(n - n % 16)


def _pair_keys(line: Column, n: Column, rung: Column, asked: bool) -> Column:
    """Keys of a line of n >= rung - 2 characters that hold for two edits.

    A line begins with a part P and ends with a part S, of rung - 2 characters in all. If one of
    them has no edit, it is equal. Else each has one edit, which leaves one half of it: P1 and S2
    stand where they stood, P2 is moved by one character at most, as counted from the start, and
    S1 as counted from the end. With P2 and S1 all that lies between them is equal too. Parts that
    may have moved are taken without their last (in S1, first) character, and looked for a second
    time moved by one: so a move in either direction is met from one of the two sides.
    """
    m = rung - 2
    p = F.shiftright(m, 1)
    p1, s = F.shiftright(m, 2), m - p
    s2 = F.shiftright(m + 1, 2)
    p2, s1 = p - p1, s - s2
    fore = lambda begin, size: F.substring(line, begin + F.lit(1), size)
    aft = lambda behind, size: F.substring(line, n - behind - size + F.lit(1), size)
    zero, move = F.lit(0), F.lit(1 if asked else 0)
    moved = [
        (3, fore(zero, p1), aft(s2 + move, s1 - 1)),
        (4, fore(p1 + move, p2 - 1), aft(zero, s2)),
        (5, fore(p1 + move, p2 + s1 - 1), F.lit("")),
    ]
    still = [(0, fore(zero, p), F.lit("")), (1, F.lit(""), aft(zero, s)), (2, fore(zero, p1), aft(zero, s2))]
    return F.array(*[F.xxhash64(rung.cast("int"), F.lit(k), a, b) for k, a, b in (moved if asked else still + moved)])


def rungs(n: Column) -> Column:
    """The steps that a line of n characters meets others on: its own, and the next one if a line
    longer by two may be on it."""
    return F.array_distinct(F.array(_rung(n), _rung(n + 2)))


def segment_keys(line: Column, n: Column, edits: int = EDITS, rung: Column | None = None) -> Column:
    """Keys under which a line of n characters is found.

    With one edit a line has two segments. The segment without an edit is equal, and the other,
    split into two again, has an equal half: so all but one quarter is, and a key is of all but
    one quarter. With two edits a key is of two of four parts, on each of
    the line's `rungs`. With more a key is of one segment.
    """
    if edits == 1:
        return F.array(*[_key_around(line, n, q, 0) for q in range(4)])
    if edits == 2:
        return _pair_keys(line, n, rung, False)
    return F.array(*[_key(line, n, i, 0, edits + 1) for i in range(edits + 1)])


def probe_keys(line: Column, n: Column, edits: int = EDITS, rung: Column | None = None) -> Column:
    """Keys to look for: of lines that are shorter by up to `edits`, or as long, within `edits`.

    Of the edits at most i lie before segment i and edits - i behind it, which bounds the shift
    from both sides. Lines of one length within one edit have equal keys of their own.
    """
    if edits == 1:
        return F.array(*[_key_around(line, n - 1, q, 1) for q in range(4)])
    if edits == 2:
        return _pair_keys(line, n, rung, True)
    keys = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            keys += [_key(line, n - less, i, shift, edits + 1) for shift in range(low, high + 1) if less or shift]
    return F.array(*keys)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def banded_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """The edit distance of two texts where it is `edits` or less, else more than `edits`.

    Columns run over the letters of b. Bit k of a word stands for row j - edits + k of column j,
    counted from 1; vp and vn mark rows that are one more or one less than the row above. The
    distance is followed along the lowest diagonal of the band, then along the last row.
    """
    width = 2 * edits + 1
    mask = F.lit((1 << width) - 1).cast("long")
    one = lambda k: F.lit(1 << k).cast("long")
    bit = lambda word, k: F.call_function("shiftright", word, k).bitwiseAND(F.lit(1))
    rows, columns = F.split(a, ""), F.split(b, "")

    def distance(x: Column) -> Column:
        m = F.size(x["rows"])

        def step(s: Column, letter: Column) -> Column:
            j = s["j"] + 1
            equal = F.lit(0).cast("long")
            for k in range(width):
                equal = equal + F.when(F.get(x["rows"], j + (k - edits - 1)) == letter, one(k)).otherwise(F.lit(0).cast("long"))

            def with_equal(e: Column) -> Column:
                zero = (
                    (e.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(e).bitwiseOR(s["vn"]).bitwiseAND(mask)
                )
                return _let(zero, after)

            def after(d: Column) -> Column:
                more = s["vn"].bitwiseOR(F.bitwise_not(d.bitwiseOR(s["vp"]))).bitwiseAND(mask)
                less = d.bitwiseAND(s["vp"])
                last = m - j + edits  # the bit of the last row, once the band reaches it
                moved = F.when(j + edits <= m, F.lit(1) - bit(d, F.lit(width - 1))).otherwise(bit(more, last) - bit(less, last))
                half = F.shiftright(d, 1)
                return F.struct(
                    less.bitwiseOR(F.bitwise_not(half.bitwiseOR(more))).bitwiseAND(mask).alias("vp"),
                    half.bitwiseAND(more).alias("vn"),
                    (s["n"] + moved.cast("int")).alias("n"),
                    j.alias("j"),
                )

            return _let(equal, with_equal)

        start = F.struct(
            F.lit(((1 << width) - 1) & ~((1 << edits) - 1)).cast("long").alias("vp"),
            F.lit(0).cast("long").alias("vn"),
            F.lit(edits).alias("n"),
            F.lit(0).alias("j"),
        )
        return F.aggregate(x["columns"], start, step, lambda s: s["n"])

    apart = F.abs(F.length(a) - F.length(b)) > edits
    return F.when(apart, F.lit(edits + 1)).otherwise(_let(F.struct(rows.alias("rows"), columns.alias("columns")), distance))


def letter_counts(line: Column) -> Column:
    """How often each of LETTERS stands in the line, four bits each, in one number."""
    count = lambda c: F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
    packed = F.lit(0).cast("long")
    for i, c in enumerate(LETTERS):
        packed = packed.bitwiseOR(F.shiftleft(count(c).cast("long").bitwiseAND(F.lit(15)), 4 * i))
    return packed


def counts_agree(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether the letter counts allow for the distance: an edit takes away one letter, adds one, or
    both. Counts are known modulo 16, and differ by at least their distance on that circle."""
    apart = F.lit(0).cast("long")
    for i in range(len(LETTERS)):
        d = (F.shiftright(a, 4 * i) - F.shiftright(b, 4 * i)).bitwiseAND(F.lit(15))
        apart = apart + F.least(d, F.lit(16) - d)
    return apart <= 2 * edits


def text_hash() -> Column:
    """With the id it tells rows apart: ids may be null or repeat. Copies of one row share it."""
    return F.xxhash64(F.col("text").cast("string"))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, t (the hash of the whole text), line_no (from 0), line and two hashes of each line
    that takes part.

    Texts are cut at each newline. Lines of fewer than `min_chars` characters, and those without a
    word, take no part. A null id counts as the largest.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    cut = docs.select(doc.alias("doc_id"), text_hash().alias("t"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line"))
    used = cut.where((F.length("line") >= min_chars) & F.col("line").rlike(WORD))
    return used.select("doc_id", "line_no", "t", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))


def near_lines(seen: DataFrame, edits: int = EDITS) -> DataFrame:
    """The links between classes of equal lines: a and b, the h of two classes within `edits`,
    with the first places of both, each link once.

    Equal lines are combined before their shuffle, so one line that a third of all texts hold is
    one row for each task. Lines meet by hashed segments, with nothing left out, and candidates
    are verified on their texts. Keys to be found and keys to look for are dealt out together:
    one shuffle serves both sides of the join.

    Most keys are of one line only, and go first. Many lines may share a key and still be far
    apart, as variants of a text in which different words were replaced are. So lines that are
    left get their length and letter counts, and only those meet whose counts allow for the
    distance: pairs that are written down follow the links, not the squares of such groups.
    """
    classes = seen.groupBy("h").agg(F.min(F.struct("doc_id", "line_no", "t", "h2", "line")).alias("first"))
    sized = classes.select("h", F.col("first.line").alias("line"), F.length("first.line").alias("n"))
    n, line = F.col("n"), F.col("line")
    stepped = sized.withColumn("rung", F.explode(rungs(n)) if edits == 2 else n)
    own, asked = segment_keys(line, n, edits, F.col("rung")), probe_keys(line, n, edits, F.col("rung"))
    keyed = stepped.select("h", own.alias("own"), asked.alias("asked"))
    tagged = keyed.select("h", F.posexplode(F.concat("own", "asked")).alias("place", "key"), F.size("own").alias("owned"))
    keys = tagged.select("key", "h", (F.col("place") < F.col("owned")).alias("own")).repartition("key")
    # a key that no line owns joins nothing
    shared = keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("own").alias("owned"))
    shared = shared.where("low != high AND owned").select("key")
    # Inner joins with distinct keys, as semi joins would move below the aggregation and repeat it.
    # Each use of the keys asks for the same columns, so that they are dealt out once.
    met = keys.join(shared, "key")
    counted = sized.join(met.groupBy("h").agg(F.max("own").alias("owned")).where("owned IS NOT NULL"), "h").select("h", "n", letter_counts(line).alias("counts"))
    met = met.join(counted, "h")
    x, y = met.alias("x"), met.alias("y")
    meet = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.h") < F.col("y.h"))
        & (F.col("x.own") | F.col("y.own"))
        & (F.abs(F.col("x.n") - F.col("y.n")) <= edits)
        & counts_agree(F.col("x.counts"), F.col("y.counts"), edits)
    )
    pairs = x.join(y, meet).select(F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct()
    place = lambda c: F.struct(f"{c}.doc_id", f"{c}.line_no", f"{c}.t", f"{c}.h2")
    left = pairs.join(classes.select(F.col("h").alias("a"), F.col("first").alias("x")), "a")
    both = left.join(classes.select(F.col("h").alias("b"), F.col("first").alias("y")), "b")
    near = both.where(banded_distance(F.col("x.line"), F.col("y.line"), edits) <= edits)
    return near.select("a", "b", place("x").alias("a_first"), place("y").alias("b_first"))


def _verdicts(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """The rows of judged_lines with t, the hash of the whole text."""
    if 2 * edits + 2 > min_chars:
        raise ValueError("a line needs letters for each segment")
    seen = occurrences(docs, min_chars)
    near = saved(near_lines(seen, edits), "near-lines")
    seen = saved(seen.select("h", "h2", "doc_id", "line_no", "t"), "line-places")
    classes = seen.groupBy("h").agg(F.min(F.struct("doc_id", "line_no", "t", "h2")).alias("first"))
    ways = near.select(F.col("a").alias("h"), "a_first", F.col("b_first").alias("other")).union(
        near.select("b", F.col("b_first"), F.col("a_first"))
    )
    linked = ways.groupBy("h").agg(
        F.count(F.lit(1)).alias("n_links"), F.min(F.when(F.col("other") < F.col("a_first"), F.col("other"))).alias("near")
    )
    verdicts = classes.join(linked, "h", "left")
    joined = seen.join(verdicts, "h")
    same = F.col("h2") == F.col("first.h2")
    here = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no")) & (F.col("t") == F.col("first.t"))
    return joined.select(
        F.when(F.col("doc_id") != 2**63 - 1, F.col("doc_id")).alias("doc_id"),
        "line_no",
        "t",
        F.when(same, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("first_doc"),
        F.when(same, F.col("first.line_no")).otherwise(F.col("line_no")).alias("first_line"),
        F.when(same, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(same, F.col("near.doc_id")).alias("near_doc"),
        F.when(same, F.col("near.line_no")).alias("near_line"),
        (~same | (here & F.col("near").isNull())).alias("kept"),
    )


def judged_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that takes part.

    doc_id, line_no; first_doc and first_line, the first of the lines equal to it (the class);
    n_links, the number of other classes within `edits`; near_doc and near_line, the first line of
    the earliest such class that begins before its own (else null); and kept. A line is kept if it
    is the first of its class and no earlier class is near. Rows that repeat an id and text are
    kept alike; of different texts under one id, or without one, the least by hash counts as first.
    A line whose hash is shared by a different one (64 bits) is kept as it is.
    """
    return _verdicts(docs, edits, min_chars).drop("t")


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` without the lines that are not kept; columns stay as they are.

    Texts that lose their last word that way are left out: all they held stands in earlier texts.
    Other texts keep their order of lines. Verdicts are by id and text, so rows without an id and
    different texts under one id don't share them. Texts without a dropped line are not changed, also
    null and empty ones.
    """
    used = ("doc_id", "text")
    given = numbered(docs, *used)
    dropped = _verdicts(given, edits, min_chars).where(~F.col("kept"))
    doc = lambda c: F.coalesce(c, F.lit(2**63 - 1))
    gone = dropped.groupBy(doc(F.col("doc_id")).alias("_doc"), F.col("t").alias("_t")).agg(F.collect_set("line_no").alias("_gone"))
    keyed = given.withColumn("_doc", doc(F.col("doc_id").cast("long"))).withColumn("_t", text_hash())
    lines = F.split("text", "\n")
    rest = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    joined = keyed.join(gone, ["_doc", "_t"], "left").withColumn("_rest", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(rest))
    left_over = F.col("_gone").isNull() | F.col("_rest").rlike(WORD)
    return named_back(joined.where(left_over).withColumn("text", F.col("_rest")), docs, *used)


#: The verdicts as SQL over `documents`. Of three segments of a line one is equal in each line within
#: two edits, moved by two places at most; so lines meet in it, and all that meet are compared.
LINES_SQL = r"""
WITH cut AS (
  SELECT doc_id, unnest(range(len(l)))::INT AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
), seen AS (
  SELECT * FROM cut WHERE length(line) >= 20 AND regexp_matches(line, '[^\x20\x09-\x0D]')
), classes AS (
  SELECT line, min((doc_id, line_no)) AS first, length(line) AS n FROM seen GROUP BY line
), segments AS (
  SELECT line, n, i, substr(line, i * (n // 3) + 1, CASE i WHEN 2 THEN n - 2 * (n // 3) ELSE n // 3 END) AS part
  FROM classes, (VALUES (0), (1), (2)) s(i)
), probes AS (
  SELECT line, n - less AS n, i, substr(line, i * ((n - less) // 3) + 1 + shift, CASE i WHEN 2 THEN n - less - 2 * ((n - less) // 3) ELSE (n - less) // 3 END) AS part
  FROM classes, (VALUES (0), (1), (2)) s(i), (VALUES (0), (1), (2)) d(less), (VALUES (-2), (-1), (0), (1), (2)) m(shift)
  WHERE i * ((n - less) // 3) + shift >= 0
), meet AS (
  SELECT DISTINCT p.line AS a, s.line AS b FROM probes p JOIN segments s ON s.n = p.n AND s.i = p.i AND s.part = p.part AND s.line <> p.line
), links AS (
  SELECT a, b FROM meet WHERE levenshtein(a, b) <= 2
), ways AS (
  SELECT l.a AS line, c.first AS place FROM (SELECT a, b FROM links UNION SELECT b, a FROM links) l JOIN classes c ON c.line = l.b
), linked AS (
  SELECT c.line, count(*) AS n_links, min(w.place) FILTER (w.place < c.first) AS near FROM classes c JOIN ways w ON w.line = c.line GROUP BY c.line
)
SELECT s.doc_id, s.line_no, c.first[1] AS first_doc, c.first[2] AS first_line, coalesce(k.n_links, 0)::BIGINT AS n_links,
       k.near[1] AS near_doc, k.near[2] AS near_line,
       ((s.doc_id, s.line_no) = c.first AND k.near IS NULL) AS kept
FROM seen s JOIN classes c ON s.line = c.line LEFT JOIN linked k ON k.line = c.line
"""
