"""Toxicity: Levenshtein automata over a lexicon trie, scored with the context of each hit.

A trie holds the lexicon's words and stems. The Levenshtein automata of all of them, intersected
with the trie, become one deterministic automaton, through which all words of a batch run side
by side, one letter at a time; most words die after a few letters. Each hit is judged with the
words around it: a quoted or reported term counts apart from one that is said outright.
"""

from __future__ import annotations

import codecs
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import fold, least_hashed, saved, texts

#: Labelled rows that lexicon and weights are learned from: those with the smallest hashed ids.
MAX_LABELLED = 40_000
MAX_TERMS = 300
MIN_DOCS = 6
#: A word with at least this many letters may be misspelled by one edit.
FUZZY_FROM = 5
WINDOW = 48
ACCEPT = 0.7
STEM_LETTERS = (4, 5, 6, 7)
N_FEATURES = 6

_WORD = re.compile(r"[^\W\d_]+")
_FANCY = str.maketrans("“”„«»‘’‚", '"""""\'\'\'')
_HAS_FANCY = re.compile("[“”„«»‘’‚]")
_REPORTED = re.compile(
    r"\b(?:said|says|called|calls|calling|wrote|quoted?|quoting|term|word|slur|insult|accused|"
    r"sagte|nannte|wort|dit|appel\w+|mot|dijo|llam\w+|palabra)\b"
)
codecs.register_error("letter", lambda e: ("ÿ" * (e.end - e.start), e.end))


def _letters() -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[65:91] = out[97:123] = True
    out[192:256] = True
    out[[215, 247]] = False
    return out


LETTER = _letters()
#: Digits and signs that stand for a letter where they are between two.
DISGUISE = np.isin(np.arange(256), np.frombuffer(b"0123456789!#$%&*+.@|_-", dtype=np.uint8))


def latin(text: str) -> bytes:
    """The text in lower case, one byte for each character; letters beyond Latin-1 are all alike."""
    text = text.lower()
    if _HAS_FANCY.search(text):
        text = text.translate(_FANCY)
    return text.encode("latin-1", "letter")


@dataclass
class Automaton:
    """next[state, kind of letter] (0: dead), and per state the best term that ends or lies there."""

    kinds: np.ndarray
    next: np.ndarray
    word: np.ndarray
    stem: np.ndarray


def build_automaton(words: list[str], stems: list[str], fuzzy_from: int = FUZZY_FROM) -> Automaton:
    """The deterministic automaton of all words within one edit, and of all words with a stem.

    Terms are numbered words first. `word` and `stem` hold 2 * term + edits + 1, or 0. Words of
    fewer than `fuzzy_from` letters and stems are taken exactly.
    """
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for i, term in enumerate([*words, *stems]):
        at = 0
        for c in latin(term):
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
            at = children[at][c]
        ends.setdefault(at, i)
    loose = {0}  # nodes from which a misspelled word can still be reached

    for at in range(len(children) - 1, -1, -1):  # children come behind their parents
        own = at in ends and ends[at] < len(words) and len(words[ends[at]]) >= fuzzy_from
        if own or any(x in loose for x in children[at].values()):
            loose.add(at)
    used = sorted({c for node in children for c in node})
    kinds = np.zeros(256, dtype=np.int64)
    kinds[LETTER] = 1
    for k, c in enumerate(used):
        kinds[c] = k + 2

    def closed(pairs: set) -> frozenset:
        best: dict[int, int] = {}
        for node, e in pairs:
            best[node] = min(e, best.get(node, 9))
        for node, e in list(best.items()):
            if e == 0:
                for child in children[node].values():  # a letter of the term is left out
                    if child in loose:
                        best[child] = min(1, best.get(child, 9))
        return frozenset(best.items())

    first = closed({(0, 0)})
    states, todo, table = {first: 1}, [first], [[0] * (len(used) + 2)]
    accepts_word, accepts_stem = [0], [0]
    while todo:
        state = todo.pop(0)
        row = [0] * (len(used) + 2)
        for k in range(1, len(used) + 2):
            c = used[k - 2] if k > 1 else None
            after = set()
            for node, e in state:
                if c in children[node]:
                    after.add((children[node][c], e))
                if e == 0 and node in loose:
                    after.add((node, 1))
                    after.update((x, 1) for x in children[node].values() if x in loose)
            if after:
                key = closed(after)
                if key not in states:
                    states[key] = len(states) + 1
                    todo.append(key)
                row[k] = states[key]
        table.append(row)
        word, stem = 0, 0
        for node, e in sorted(state, key=lambda x: (x[1], ends.get(x[0], 1 << 30))):
            i = ends.get(node)
            if i is None:
                continue
            if i < len(words) and not word and (e == 0 or len(words[i]) >= fuzzy_from):
                word = 2 * i + e + 1
            if i >= len(words) and not stem and e == 0:
                stem = 2 * i + 1
        accepts_word.append(word)
        accepts_stem.append(stem)
    return Automaton(kinds, np.array(table, dtype=np.int32), np.array(accepts_word), np.array(accepts_stem))


def run_automaton(a: Automaton, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length so far, code) of every word of the buffer that the automaton takes.

    A single digit or sign between two letters may stand for a letter: words are looked at
    without it, in parts, and with it, as a whole, in which it is a letter of no term.
    """
    buf = np.frombuffer(data + b" ", dtype=np.uint8)
    letter = LETTER[buf]
    kinds = a.kinds[buf]
    plain = _taken(a, kinds, _begins(letter))
    between = np.zeros(len(buf), dtype=bool)
    between[1:-1] = DISGUISE[buf[1:-1]] & letter[:-2] & letter[2:]
    if not between.any():
        return _in_order([plain])
    whole = letter | between
    begin = _begins(whole)
    word = np.cumsum(np.isin(np.arange(len(buf)), begin)) - 1  # the word that a place is in, or behind
    begin = begin[np.unique(word[between])]
    joined = _taken(a, np.where(between, 1, kinds), begin)
    new = ~np.isin(joined[0], plain[0])
    return _in_order([plain, tuple(x[new] for x in joined)])


def _begins(letter: np.ndarray) -> np.ndarray:
    begin = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    return np.concatenate(([0], begin)) if letter[0] else begin


def _in_order(found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s, n, c = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(s, kind="stable")
    return s[order], n[order], c[order]


def _taken(a: Automaton, kinds: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hits of words that begin at these places, and end at the next place of kind 0."""
    pos, state, found = begin, np.ones(len(begin), dtype=np.int32), []
    start = begin
    while len(pos):
        kind = kinds[pos]
        over = kind == 0
        if over.any():
            code = a.word[state[over]]
            hit = code > 0
            if hit.any():
                found.append((start[over][hit], (pos - start)[over][hit], code[hit]))
            pos, start, state, kind = pos[~over], start[~over], state[~over], kind[~over]
        state = a.next[state, kind]
        stem = a.stem[state]
        if stem.any():
            hit = stem > 0
            found.append((start[hit], (pos - start)[hit] + 1, stem[hit]))
            state = np.where(hit, 0, state)
        live = state > 0
        pos, start, state = pos[live] + 1, start[live], state[live]
    return _in_order(found) if found else tuple(np.empty(0, dtype=np.int64) for _ in range(3))


def quoted(data: bytes, start: int, length: int, window: int = WINDOW) -> bool:
    """Whether the hit stands between quotation marks, or close behind a word of reporting."""
    before = data[max(0, start - window) : start].decode("latin-1")
    after = data[start + length : start + length + window].decode("latin-1")
    opened = before.count('"') % 2 == 1 and '"' in after
    return opened or bool(_REPORTED.search(before.rpartition(".")[2]))


@dataclass
class Model:
    automaton: Automaton
    value: np.ndarray
    weights: np.ndarray


def doc_features(model_values: np.ndarray, data: bytes, hits: tuple) -> np.ndarray:
    """Features of one text: bias, summed values of hits that are said outright, of the misspelled
    among them, and of quoted ones, whether any outright hit tells against the text, and such hits
    per word. A misspelling is one of the hits, so it counts even if no labelled text has any."""
    said = fuzzy = quote = n = 0.0
    for s, k, code in zip(*hits, strict=True):
        v = model_values[code]
        if quoted(data, int(s), int(k)):
            quote += v
            continue
        said += v
        n += v > 0
        if code % 2 == 0:
            fuzzy += v
    words = max(1, len(data.split()))
    return np.array([1.0, np.tanh(said / 4), np.tanh(fuzzy / 4), np.tanh(quote / 4), float(n > 0), np.log1p(100 * n / words)])


def _batched(batch: pa.RecordBatch, at: int, size: int = 512) -> Iterator[tuple[int, bytes, np.ndarray]]:
    for i in range(0, batch.num_rows, size):
        parts = [latin(t) for t in texts(batch.column(at).slice(i, size))]
        ends = np.cumsum([len(p) + 1 for p in parts])
        yield i, b"\n".join(parts), np.concatenate(([0], ends))


def _hits(a: Automaton, data: bytes, bounds: np.ndarray) -> list[tuple[bytes, tuple]]:
    s, n, c = run_automaton(a, data)
    cut = np.searchsorted(s, bounds)
    out = []
    for i in range(len(bounds) - 1):
        lo, hi = cut[i], cut[i + 1]
        out.append((data[bounds[i] : bounds[i + 1] - 1], (s[lo:hi] - bounds[i], n[lo:hi], c[lo:hi])))
    return out


def _terms(text: str) -> Iterator[tuple[str, int]]:
    """Words and stems (with a star), each with its place among the words."""
    words = _WORD.findall(text.lower())
    for i, w in enumerate(words):
        yield w, i
        for k in STEM_LETTERS:
            if len(w) > k:
                yield w[:k] + "*", i


def learn_lexicon(sample: DataFrame, limit: int = MAX_TERMS, min_docs: int = MIN_DOCS) -> tuple[list[str], list[str]]:
    """Words and stems that mark toxic texts of a bounded, labelled sample (label, text).

    A term must stand in `min_docs` toxic texts or more, with as many different neighbours, so
    that words of one copied text don't count, and be at least 30 times as frequent in toxic
    texts. A stem is taken where it has clearly more than any one of its words.
    """

    def counted(wanted: int, only: frozenset | None, contexts: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n: Counter = Counter()
            for b in batches:
                for label, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                    if label != wanted:
                        continue
                    if contexts:
                        words = _WORD.findall(text.lower())
                        seen = set()
                        for w, i in _terms(text):
                            if w in only:
                                seen.add((w, " ".join(words[max(0, i - 1) : i] + words[i + 1 : i + 2])))
                        n.update(seen)
                    else:
                        terms = {w for w, _ in _terms(text)}
                        n.update(terms if only is None else terms & only)
            keys = list(n)
            if contexts:
                cols = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
            else:
                cols = [pa.array(keys, pa.string()), pa.array([None] * len(keys), pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([n[k] for k in keys], pa.int64())], names=["term", "context", "n"])

        return sample.select("label", "text").mapInArrow(run, "term string, context string, n long")

    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return [], []
    frequent = counted(1, None, False).groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    # the sample is bounded, and so are the terms of its toxic texts
    toxic = {r["term"]: r["n"] for r in frequent.orderBy(F.desc("n"), "term").limit(60_000).collect()}
    clean = {r["term"]: r["n"] for r in counted(0, frozenset(toxic), False).groupBy("term").agg(F.sum("n").alias("n")).collect()}
    pure = {t: n for t, n in toxic.items() if n / n_toxic >= 30 * (clean.get(t, 0) + 0.2) / n_clean and len(t.rstrip("*")) > 3}
    if not pure:
        return [], []
    around = (
        counted(1, frozenset(pure), True).groupBy("term").agg(F.count_distinct("context").alias("n")).where(F.col("n") >= min_docs)
    )
    good = {r["term"]: r["n"] for r in around.collect()}
    return choose_terms(good, limit)


def choose_terms(good: dict[str, int], limit: int) -> tuple[list[str], list[str]]:
    """Words and stems from terms with their numbers of different neighbours."""
    words = {t: n for t, n in good.items() if not t.endswith("*")}
    stems: dict[str, int] = {}
    for t, n in sorted(((t[:-1], n) for t, n in good.items() if t.endswith("*")), key=lambda x: (-len(x[0]), x[0])):
        longest = max((m for w, m in words.items() if w.startswith(t)), default=0)
        longer = [s for s in stems if s.startswith(t)]
        if n >= 1.5 * longest and n >= 1.1 * sum(stems[s] for s in longer):
            for s in longer:
                del stems[s]
            stems[t] = n
    words = {w: n for w, n in words.items() if not any(w.startswith(s) for s in stems)}
    top = sorted([*words.items(), *((s + "*", n) for s, n in stems.items())], key=lambda x: (-x[1], x[0]))[:limit]
    return sorted(t for t, _ in top if not t.endswith("*")), sorted(t[:-1] for t, _ in top if t.endswith("*"))


def learn(docs: DataFrame, labels: DataFrame, train: Column, limit: int = MAX_LABELLED, extra: tuple = ()) -> Model:
    """Lexicon (with the words in `extra`), values of its terms and weights, from labelled rows.

    At most `limit` labels of rows where `train` holds are read, by hashed id; only those ids are
    broadcast. Null labels and ids teach nothing.
    """
    usable = labels.where(train & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").alias("label")
    )
    chosen = least_hashed(usable, "doc_id", limit)
    sample = saved(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text"), "toxic", compression="zstd")
    words, stems = learn_lexicon(sample)
    words = sorted({*words, *(w.lower() for w in extra)})
    automaton = build_automaton(words, stems)
    n_codes = 2 * (len(words) + len(stems)) + 2

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, n_codes + 1), dtype=np.int64)
        for b in batches:
            labels_ = b.column(0).to_pylist()
            for i, data, bounds in _batched(b, 1):
                for j, (_, hits) in enumerate(_hits(automaton, data, bounds)):
                    label = labels_[i + j]
                    n[label, n_codes] += 1
                    n[label, np.unique(hits[2])] += 1
        yield pa.RecordBatch.from_arrays([pa.array(n[0]), pa.array(n[1]), pa.array(np.arange(n_codes + 1))], names=["clean", "toxic", "code"])

    rows = sample.mapInArrow(codes, "clean long, toxic long, code long").groupBy("code").agg(F.sum("clean"), F.sum("toxic")).collect()
    counts = np.zeros((2, n_codes + 1))
    for code, clean, toxic in rows:
        counts[:, code] = clean, toxic
    total = np.maximum(counts[:, n_codes :], 1)
    odds = np.log((counts[1] + 0.3) / total[1]) - np.log((counts[0] + 0.3) / total[0])
    seen = counts.sum(0)
    prior = np.where(np.arange(n_codes + 1) % 2 == 0, 1.0, 2.0)  # misspelled terms are trusted less
    value = np.clip((odds * seen + prior * 2) / (seen + 2), -1.0, 8.0)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [doc_features(value, d, h).tolist() for _, data, bounds in _batched(b, 1) for d, h in _hits(automaton, data, bounds)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    # a few numbers for each of the sample's rows, which are bounded
    kind = sample.schema["label"].dataType.simpleString()
    table = sample.mapInArrow(measured, f"label {kind}, x array<double>").toArrow()
    x = np.array(table.column("x").to_pylist(), dtype=float).reshape(-1, N_FEATURES)
    return Model(automaton, value, logistic(x, np.array(table.column("label").to_pylist(), dtype=float)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a penalised logistic regression by Newton's method; the first column is the bias."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    ridge = penalty * np.diag([1e-6, *[1.0] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and n_hits of every row of `docs`; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, n = [], []
            for _, data, bounds in _batched(b, 1):
                for d, hits in _hits(model.automaton, data, bounds):
                    z = doc_features(model.value, d, hits) @ model.weights
                    scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                    n.append(len(hits[2]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(n, pa.int64())], names=["doc_id", "score", "n_hits"])

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double, n_hits long")


def toxicity_report(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits of every row; labels of the held-out fold are never read."""
    model = learn(docs, labels, fold(F.col("doc_id"), folds) != held)
    return toxicity_scores(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        "n_hits",
    )
