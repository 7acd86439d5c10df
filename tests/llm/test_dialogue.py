"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import groupby

import pytest

from flowframe.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string, pos int, edits string"
GOOD = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def judge(rows):
    """One conversation's rows, in order, with their faults."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, out = set(), []
    for _, turn, role, text in rows:
        bare = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def cheapest(rows):
    """The least (cost, audit) and its lines: whole audits are compared, roles held against the pattern's prefixes."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    best = None
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if at == len(rows) and state in ("", "a"):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        if (cost, audit, at, state) in done or len(audit) > 2 * len(rows) + 3:
            continue
        done.add((cost, audit, at, state))
        for t, name in (("u", "user"), ("a", "assistant")):
            if (state, t) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", at, step[state, t], (*lines, f"{name}:")))
        if at < len(rows):
            _, role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, lines))
            if fault not in (1, 2):
                more = 3 if fault == 3 else 0
                if (state, role[:1]) in step:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, step[state, role[:1]], (*lines, f"{role}:{text}")))
                for t, name in (("u", "user"), ("a", "assistant")):
                    if (state, t) in step:
                        heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, step[state, t], (*lines, f"{name}:{text}")))
    return best


def brute_force(rows, hurt=True):
    want = {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    left = damaged(rows) if hurt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    by = {k: list(g) for k, g in groupby(sorted(left, key=key), key=lambda r: r[0])}
    for conv in {r[0] for r in rows}:
        own = judge(by.get(conv, []))
        turns = {r[0] for r in own if r[0] is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = cheapest(own)
        assert GOOD.fullmatch("".join(x[0] if x else " " for x in lines))
        want[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[sum(r[3] == k for r in own) for k in (1, 2, 3)],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return want


def talks(seed, n):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", " ", "", "Zwölf .\x0b\n", "日本。", "tab\t", "ends. "]
    rows = []
    for conv in range(n):
        length = r.choice([1, 2, 3, 4, 5, 6, 7])
        for turn in range(length):
            role = r.choice(["user", "assistant"]) if r.random() < 0.3 else ("user", "assistant")[turn % 2]
            if r.random() < 0.15:
                role = r.choice(["system", None, "", "tool", "User", "umpire"])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None, 0]), role, None if r.random() < 0.1 else r.choice(texts) + r.choice(["", str(turn) + "."])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)


def as_dict(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("hurt", [True, False])
def test_repairs(spark, hurt):
    rows = talks(3 + hurt, 250) + [(None, 1, "user", "a row without an id."), (None, 2, "assistant", "and one more."), (None, None, "system", "first.")]
    rows += rows[:5] + [(900, 0, "user", "x " * 200_000 + "."), (900, 1, "assistant", "y.")]
    got = as_dict(dialogue.repair_report(frame(spark, rows), damaged=hurt))
    assert got == brute_force(rows, hurt)
    assert len({a for *_, a, _ in got.values()}) > 40


def test_a_long_conversation_of_one_role(spark):
    """Whichever of many equally cheap repairs is least is known without comparing whole audits."""
    rows = [(1, i, "user", f"row {i}.") for i in range(9)]
    assert as_dict(dialogue.repair_report(frame(spark, rows), damaged=False)) == brute_force(rows, False)
    talk = dialogue.Repair()
    for i in range(20_000):
        talk.feed("u", 0)
    cost, audit, _ = talk.finish()
    assert len(talk.back) == dialogue.TOPS * 20_000 and cost == 30_000 and set(audit) == {"K", "R"}


def test_dropped_and_empty(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = as_dict(dialogue.repair_report(frame(spark, [(gone, 0, "user", "hello.")])))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert dialogue.repair_report(frame(spark, [(1, 0, "u", "x")]).limit(0)).count() == 0


def test_repaired_rows_are_those_of_the_digest(spark):
    rows = talks(9, 80)
    judged = dialogue.judged(dialogue.damage(frame(spark, rows)))
    found = dialogue.repairs(judged)
    repaired = {}
    for x in dialogue.repaired_rows(judged, found.select("conv_id", "pos", "edits")).orderBy("conv_id", "pos", "part").collect():
        repaired.setdefault(x["conv_id"], []).append(f"{x['role']}:{x['text']}")
    for conv, want in brute_force(rows).items():
        assert hashlib.sha256("\n".join(repaired.get(conv, [])).encode()).hexdigest() == want[-1]
