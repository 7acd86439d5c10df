"""What the signals of a flow gained and lost between two moments.

A source tells its rows of before and the ones that came since; from there each operator has a
rule for its own change, so a pull computes what the new rows reach instead of the whole result:

* operators that look at one row at a time are applied to the change alone;
* an inner join gains what new rows find on the other side, old or new;
* where rows of a key depend on each other (freshest rows, events, de-duplication, nested lists,
  outer joins), the keys that the change touches are computed before and after, and compared;
* anything else is computed before and after as a whole.

Frames are lazy: the rows of before are read only where a rule asks for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators import events, incremental, relational
from flowframe.operators.columns import quoted, safe_name
from flowframe.plans import flow as flows
from flowframe.plans.flow import Flow, FlowError, Node, truth
from flowframe.sources import landing


@dataclass(frozen=True)
class Delta:
    """A table of before, the rows it gained, and the rows it lost (None: none can be lost).

    Rows count as often as they occur.
    """

    before: DataFrame
    gained: DataFrame
    lost: DataFrame | None = None

    @property
    def after(self) -> DataFrame:
        rows = self.before.unionByName(self.gained)
        return rows if self.lost is None else rows.exceptAll(self.lost)

    def each(self, f: Callable[[DataFrame], DataFrame]) -> Delta:
        return Delta(f(self.before), f(self.gained), None if self.lost is None else f(self.lost))

    def net(self) -> Delta:
        """Without rows that are lost and gained alike, as after a projection of what differed."""
        if self.lost is None:
            return self
        return Delta(self.before, self.gained.exceptAll(self.lost), self.lost.exceptAll(self.gained))

    def changed(self) -> DataFrame:
        return self.gained if self.lost is None else self.gained.unionByName(self.lost)


#: Operators that look at one row at a time.
ROW_BY_ROW = (
    "tee", "project", "filter", "dropColumns", "withColumn", "withColumns", "withColumnRenamed", "select", "explodeArray", "popStruct",
    "sort", "ruleScript", *flows.SINKS,
)


def touching(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `df` whose key columns are among the rows of `keys`; null is a key like others."""
    named = keys.select(*[F.col(quoted(c)).alias(f"__key{i}") for i, c in enumerate(keys.columns)])
    same = [F.col(quoted(c)).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(keys.columns)]
    return df.join(named, reduce(lambda a, b: a & b, same), "left_semi")


def recomputed(inputs: Sequence[Delta], run: Callable[..., DataFrame]) -> Delta:
    """The difference of the whole results before and after."""
    old, new = run(*[d.before for d in inputs]), run(*[d.after for d in inputs])
    return Delta(old, new.exceptAll(old), old.exceptAll(new))


def by_key(inputs: Sequence[Delta], keys: Sequence[str], run: Callable[..., DataFrame]) -> Delta:
    """The difference of the results for the keys that a change touches.

    `run` must give each result row from input rows of one key alone.
    """
    pick = [F.col(quoted(c)) for c in keys]
    touched = reduce(DataFrame.union, [d.changed().select(*pick) for d in inputs]).distinct()
    old = run(*[touching(d.before, touched) for d in inputs])
    new = run(*[touching(d.after, touched) for d in inputs])
    return Delta(run(*[d.before for d in inputs]), new.exceptAll(old), old.exceptAll(new))


def join_inner(left: Delta, right: Delta, cols: Sequence[str]) -> Delta:
    """New rows find partners among old and new ones, and lost rows take their pairs along."""
    meet = lambda a, b: relational.join(a, b, cols, "inner")
    before = meet(left.before, right.before)
    if left.lost is None and right.lost is None:
        return Delta(before, incremental.join_delta(left.before, left.gained, right.after, right.gained, cols))
    signed = lambda d: [(d.gained, 1)] + ([] if d.lost is None else [(d.lost, -1)])
    terms = [(meet(left.before, r), s) for r, s in signed(right)] + [(meet(x, right.before), s) for x, s in signed(left)]
    terms += [(meet(x, r), s * t) for x, s in signed(left) for r, t in signed(right)]
    more, less = (reduce(DataFrame.unionByName, [f for f, s in terms if s == sign]) for sign in (1, -1))
    # a pair may be lost with one of its rows and come back with the other
    return Delta(before, more.exceptAll(less), less.exceptAll(more))


def union_all(inputs: Sequence[Delta], run: Callable[..., DataFrame]) -> Delta:
    none = lambda d: d.before.limit(0) if d.lost is None else d.lost
    lost = None if all(d.lost is None for d in inputs) else run(*[none(d) for d in inputs])
    return Delta(run(*[d.before for d in inputs]), run(*[d.gained for d in inputs]), lost)


def looks_across_rows(df: DataFrame, given: DataFrame) -> bool:
    """Whether an expression of an operator brought in a window over other rows."""
    windows = lambda x: x._jdf.queryExecution().analyzed().toString().count("Window [")
    return windows(df) > windows(given)


class Changes:
    """The deltas of a flow's signals for the rows that came after `since`, up to `till`.

    The time of a source's rows is its option `timestamp`, else `ts` where it has such a column.
    Rows without a time count as of before. Where the column that its option `monthCol` names
    holds the month (YYYYMM) of each row's time, as directories of months do, months before
    `since` are not read for what is new. A landed drop with a `cleanDataPath` is held against the
    state of that landed data. Sources without a time must be `given` as deltas. With
    `since` None everything up to `till` is new.
    """

    def __init__(self, flow: Flow, since: str | None, till: str, ts: str | None = None, given: Mapping[str, Delta] | None = None):
        self.flow, self.since, self.till, self.ts = flow, since, till, ts
        self.deltas: dict[str, Delta] = dict(given or {})

    def of(self, signal: str) -> Delta:
        if signal not in self.deltas:
            node = self.flow.producer(signal)
            inputs = [self.of(s) for s in node.sources]
            made = self._operator(node, inputs) if inputs else self._source(node, signal)
            outputs = made if isinstance(made, tuple) else (made,) * max(len(node.outputs), 1)
            self.deltas.update(zip(node.outputs, outputs))
        return self.deltas[signal]

    def _source(self, node: Node, signal: str) -> Delta:
        df = self.flow.frame(signal)
        if node.kind == "preprocessor" and node.options.get("cleanDataPath"):
            return self._landed(node, df)
        ts = node.options.get("timestamp") or self.ts
        if not ts or ts not in df.columns:
            raise FlowError(f"source {signal!r} names no timestamp: give its change")
        at, month = F.col(quoted(ts)), node.options.get("monthCol")
        new = at <= F.lit(self.till)
        if self.since is None:
            return Delta(df.limit(0), df.filter(F.coalesce(new, F.lit(True))))
        before, new = F.coalesce(at <= F.lit(self.since), F.lit(True)), new & (at > F.lit(self.since))
        if month:
            digits = lambda t: "".join(c for c in t if c.isdigit())[:6]
            number = F.col(quoted(month)).cast("string")
            new, before = new & (number >= digits(self.since)) & (number <= digits(self.till)), before & (number <= digits(self.since))
        return Delta(df.filter(before), df.filter(new))

    def _landed(self, node: Node, rows: DataFrame) -> Delta:
        """A drop against the current state of what was landed before (`cleanDataPath`), up to `till`."""
        o, names = node.options, flows.landed_names(node.options)
        named = lambda c: names.get(c, safe_name(c))
        stamps = o.get("srcTimestamp") or []
        clean = self.flow.spark.read.format(o.get("cleanDataFormat", "avro").lower()).load(o["cleanDataPath"])
        known = rows.filter(F.col("DERIVED_TS") <= F.lit(self.till))
        view = landing.land_resumed(known, clean, [named(k) for k in o["keyCols"]], [named(c) for c in ([stamps] if isinstance(stamps, str) else stamps)])
        return Delta(relational.union_ragged(view.previous, rows.limit(0)), relational.union_ragged(view.new, view.previous.limit(0)))

    def _operator(self, node: Node, inputs: list[Delta]) -> Delta | tuple[Delta, ...]:
        build, o, first = flows.OPERATORS.get(node.kind), node.options, inputs[0]
        if build is None:
            raise FlowError(f"unknown operator type {node.kind!r}")
        run = lambda *frames: build(self.flow, node, list(frames))
        only = lambda *frames: run(*frames)[0] if isinstance(run(*frames), tuple) else run(*frames)
        if node.kind == "split" and not truth(o.get("distinct")):
            return tuple(first.each(lambda df, i=i: run(df)[i]) for i in range(2))
        if node.kind == "split":
            return tuple(recomputed([first], lambda df, i=i: run(df)[i]) for i in range(2))
        if node.kind == "union":
            return union_all(inputs, run)
        if node.kind == "join":
            if o.get("joinType", "inner") == "inner":
                return join_inner(first, inputs[1], o["cols"])
            return by_key(inputs, o["cols"], run)
        if node.kind == "joinToEvents":
            how = o.get("joinType", "inner")
            joined = join_inner(first, inputs[1], o["cols"]) if how == "inner" else by_key(inputs, o["cols"], lambda a, b: relational.join(a, b, o["cols"], how))
            made = lambda df: events.to_events(df, o["keyCols"], o["timestamp_a"], o["timestamp_b"], o["eventTimestamp"])
            return by_key([joined], o["keyCols"], made)
        if node.kind in ("freshestRows", "toEvents"):
            return by_key(inputs, o["keyCols"], run)
        if node.kind == "deDup":
            ignored = (o["eventTimestamp"], *(o.get("ignorableCols") or []))
            return by_key(inputs, [c for c in first.before.columns if c not in ignored], run)
        if node.kind == "pushStruct" and truth(o.get("asArray")):
            rest = [c for c in first.before.columns if c not in o["cols"]]
            return by_key(inputs, rest, run) if rest else recomputed(inputs, run)
        if node.kind == "subFlow":
            spec = o.get("flow") or self.flow.flows[o["flowName"]]
            inner = flows.parse_flow(self.flow.spark, spec, self.flow.functions, self.flow.preview)
            names = o.get("inputs") or node.sources
            inner._frames.update({n: d.before for n, d in zip(names, inputs)})
            return Changes(inner, self.since, self.till, self.ts, dict(zip(names, inputs))).of(o["output"])
        if (node.kind in ROW_BY_ROW or node.kind == "pushStruct") and not looks_across_rows(only(first.before), first.before):
            return first.each(only)
        return recomputed(inputs, only)


def flow_changes(
    spark: SparkSession,
    spec: dict,
    signal: str,
    since: str | None,
    till: str,
    ts: str | None = None,
    functions: dict[str, Callable] | None = None,
    given: Mapping[str, Delta] | None = None,
) -> Delta:
    """What a signal gained and lost after `since`, up to `till`; see `Changes`."""
    return Changes(flows.parse_flow(spark, spec, functions), since, till, ts, given).of(signal).net()


def pull_changes(
    spark: SparkSession,
    spec: dict,
    sink: str,
    store: incremental.SnapshotStore,
    batch_id: int,
    since: str | None,
    till: str,
    ts: str | None = None,
    functions: dict[str, Callable] | None = None,
    given: Mapping[str, Delta] | None = None,
) -> DataFrame:
    """Write to a sink the rows its flow gained after `since`, up to `till`, and return them.

    The store keeps the gained rows under the batch's id; a batch that is run again replaces its
    own rows and files. With `since` None the history is loaded: it is written only when the
    sink's `prefetch.save` option is true. Rows that a pull takes back (an outdated freshest row)
    are not sent to the sink; `flow_changes` has them.
    """
    flow = flows.parse_flow(spark, spec, functions)
    node = sink_node(flow, sink)
    gained = Changes(flow, since, till, ts, given).of(node.sources[0]).net().gained
    fresh = store.save(gained, batch_id)
    if since is not None or truth((node.options.get("prefetch") or {}).get("save")):
        flows.write_sink(flow, node, fresh, batch_id)
    return fresh


def sink_node(flow: Flow, sink: str) -> Node:
    node = next((n for n in flow.nodes if n.kind in flows.SINKS and sink in (n.name, *n.outputs)), None)
    if node is None:
        raise FlowError(f"no sink named {sink!r}")
    return node


def catch_up_ranges(spark: SparkSession, to: str, now: str, step: str = "1 day") -> list[tuple[str, str]]:
    """The ranges (after, up to) from the end of the history to now, the last as long as is left."""
    first, last = spark.sql(f"SELECT CAST(timestamp_ntz'{to}' AS STRING), CAST(timestamp_ntz'{now}' AS STRING)").first()
    if first >= last:
        return []
    times = f"transform(sequence(timestamp_ntz'{first}', timestamp_ntz'{last}', INTERVAL {step}), t -> CAST(t AS STRING))"
    steps = list(spark.sql(f"SELECT {times}").first()[0])
    ends = [*steps[1:], *([last] if steps[-1] < last else [])]
    return list(zip(steps, ends))


def catch_up_flow(
    spark: SparkSession,
    spec: dict,
    sink: str,
    path: str,
    now: str,
    ts: str | None = None,
    functions: dict[str, Callable] | None = None,
) -> list[int]:
    """Load a sink's history and catch up to `now`, range by range; returns the batches that ran.

    The sink's options say how: `prefetch.to` ends the history (from `prefetch.from`, which may be
    open), `prefetch.save` tells whether it is written, and `catchupIncrement` is the length of a
    range ('1 day'). Batch 0 is the history, batch n the n-th range. A batch is closed when its
    marker under `path` is written, after its sink; those that are closed are left out by the next
    call, and one that was broken off runs again and replaces what it had written. A later `now`
    goes on where the last range ended: a range cut short by `now` is closed as it is.
    """
    flow = flows.parse_flow(spark, spec, functions)
    o = sink_node(flow, sink).options
    history = o.get("prefetch") or {}
    start, to, step = history.get("from") or None, history.get("to"), o.get("catchupIncrement") or "1 day"
    if not to:
        raise FlowError(f"sink {sink!r} doesn't say where its history ends (prefetch.to)")
    store, closed = incremental.SnapshotStore(spark, f"{path.rstrip('/')}/gained"), incremental.SnapshotStore(spark, f"{path.rstrip('/')}/closed")
    done = closed.known()
    ended = {r["batch"]: r["till"] for r in done.select("batch", "till").collect()} if done is not None else {}
    last = max(ended, default=0)
    plan = [] if 0 in ended else [(0, None, to)]
    plan += [(last + i, a, b) for i, (a, b) in enumerate(catch_up_ranges(spark, ended.get(last, to), now, step), 1)]
    for batch, since, till in plan:
        if batch == 0 and start:
            pull_history(spark, spec, sink, store, start, till, ts, functions)
        else:
            pull_changes(spark, spec, sink, store, batch, since, till, ts, functions)
        closed.save(spark.createDataFrame([(batch, since, till)], "batch int, since string, till string"), batch)
    return [b for b, _, _ in plan]


def pull_history(
    spark: SparkSession, spec: dict, sink: str, store: incremental.SnapshotStore, start: str, till: str, ts: str | None, functions: dict[str, Callable] | None
) -> DataFrame:
    """The history of a sink from `start` on, as batch 0."""
    flow = flows.parse_flow(spark, spec, functions)
    node = sink_node(flow, sink)
    fresh = store.save(Changes(flow, start, till, ts).of(node.sources[0]).net().gained, 0)
    if truth((node.options.get("prefetch") or {}).get("save")):
        flows.write_sink(flow, node, fresh, 0)
    return fresh
