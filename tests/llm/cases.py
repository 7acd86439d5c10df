"""Documents with every odd case, and plain Python twins of the operators."""

import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _size int, score string, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names clash."""
    full = [(*r, None, None)[:4] for r in rows]
    return spark.createDataFrame([(i, t, g, s, len(t or ""), 7, "x", 1) for i, t, g, s in full], SCHEMA)


def odd(spark, extra=()):
    long_line = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \t\n\x0b ", None, "b"),
        (4, "one", "en", "b"),
        (5, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", "de", "a"),
        (5, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", "de", "a"),
        (6, long_line, "en", "c"),
        (None, "a row without an id that is long enough to be compared", "en", "a"),
        (7, "日本語のテキスト 😀 <|endoftext|> done", "ja", "a"),
        (8, "12345 67890 !!!", None, "a"),
        *extra,
    ]
    return frame(spark, rows)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def find_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def gram_set(text, k=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))
