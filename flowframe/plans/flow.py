"""Assemble a DataFrame graph from a declared flow.

    {"connections": [{"id", "connectionType", "connection", "options"}],
     "operations":  [{"operatorType", "signals": {"sources": [...], "sinks": [...]}, "options"}]}

An operation reads the signals of its sources and produces those of its sinks. The result of
every signal is one lazy DataFrame, built once and shared by all who read it; nothing runs
until a sink writes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators import columns, events, incremental, mapping, nesting, relational, rules
from flowframe.sources import external, files, landing, sinks


class FlowError(ValueError):
    """A flow that cannot be built: unknown operator, missing signal, cycle."""


@dataclass
class Node:
    """One operation of a flow, in either dialect."""

    kind: str
    name: str
    sources: list[str]
    outputs: list[str]
    options: dict[str, Any]
    source_connection: str | None = None
    sink_connection: str | None = None


@dataclass
class Flow:
    spark: SparkSession
    nodes: list[Node]
    connections: dict[str, dict] = field(default_factory=dict)
    functions: dict[str, Callable] = field(default_factory=dict)
    flows: dict[str, dict] = field(default_factory=dict)
    preview: bool = False

    def __post_init__(self):
        self._frames: dict[str, DataFrame] = {}
        self._building: list[str] = []

    def producer(self, signal: str) -> Node:
        for node in self.nodes:
            if signal in node.outputs:
                return node
        raise FlowError(f"no operation produces signal {signal!r}")

    def frame(self, signal: str) -> DataFrame:
        """The lazy DataFrame of a signal."""
        if signal in self._frames:
            return self._frames[signal]
        if signal in self._building:
            raise FlowError("signals form a cycle: " + " -> ".join([*self._building, signal]))
        node = self.producer(signal)
        build = OPERATORS.get(node.kind)
        if build is None:
            raise FlowError(f"unknown operator type {node.kind!r}")
        self._building.append(signal)
        try:
            inputs = [self.frame(s) for s in node.sources]
        finally:
            self._building.pop()
        made = build(self, node, inputs)
        outputs = made if isinstance(made, tuple) else (made,) * max(len(node.outputs), 1)
        for name, df in zip(node.outputs, outputs):
            self._frames[name] = df
        return self._frames[signal]

    def option(self, node: Node, connection: dict, key: str, default: Any = None) -> Any:
        """Operator option beats connection option beats default."""
        for place in (node.options, connection.get("options") or {}):
            if place.get(key) not in (None, ""):
                return place[key]
        return default

    def connection(self, name: str | None) -> dict:
        if not name or name not in self.connections:
            raise FlowError(f"unknown connection {name!r}")
        return self.connections[name]


def connection_path(flow: Flow, node: Node, connection: dict) -> str:
    strings = (connection.get("connection") or {}).get("connectionStrings") or {}
    path = files.resolve_path((connection.get("options") or {}).get("path"), node.options.get("path"))
    return files.connection_uri(
        connection.get("connectionType", ""), path, strings.get("container", ""), strings.get("storageAccount", "")
    )


def projection_of(options: dict) -> list[tuple[str, str]]:
    cols = (options.get("projection") or {}).get("cols") or options.get("cols") or []
    return [(c["from"], c.get("name", c["from"])) for c in cols if isinstance(c, dict)]


def predicate_of(options: dict) -> str:
    text = options.get("expr") or (options.get("filter") or {}).get("expr") or ""
    return "" if text == "true" else text


def named_columns(options: dict) -> list[tuple[str, str]]:
    cols = options.get("cols") or []
    if cols:
        return [(c["name"], c.get("expr", c.get("expression"))) for c in cols]
    return [(options["col"], options.get("expr", "true"))]


def truth(value: Any) -> bool:
    return str(value).lower() == "true"


BUS_KINDS = ("eventhub", "event-hub", "event-hub-read", "kafka")


def partition_of(value: Any) -> tuple[str, int, int, int] | None:
    """(column, low, high, tasks) of a partitioned database read, from a list or an object."""
    if not value:
        return None
    if isinstance(value, dict):
        value = [value[k] for k in ("column", "low", "high", "tasks")]
    column, *bounds = value
    low, high, tasks = (int(x) for x in bounds)
    return column, low, high, tasks


def read_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    connection = flow.connection(node.source_connection)
    kind = connection.get("connectionType", "")
    project, where = projection_of({"projection": node.options.get("projection")}), predicate_of(node.options)
    strings = (connection.get("connection") or {}).get("connectionStrings") or {}
    if kind == "jdbc":
        return external.read_jdbc(
            flow.spark,
            strings["url"],
            table=flow.option(node, connection, "table"),
            query=flow.option(node, connection, "query"),
            user=strings.get("user"),
            password=strings.get("password"),
            driver=strings.get("driver"),
            partition=partition_of(flow.option(node, connection, "partition")),
            project=project,
            where=where,
        )
    if kind in BUS_KINDS:
        schema = flow.option(node, connection, "schema")
        if not schema:
            raise FlowError("a bus reader needs a schema, or the whole topic is read to find one")
        rate = flow.option(node, connection, "maxRatePerPartition")
        df = external.read_event_bus(
            flow.spark,
            strings["servers"],
            flow.option(node, connection, "topics"),
            schema=schema,
            start=flow.option(node, connection, "autoOffsetReset", "earliest"),
            rate=int(rate) if rate else None,
            group=flow.option(node, connection, "consumerGroup"),
        )
        df = columns.project(df, project) if project else df
        return columns.filter_rows(df, where)
    fmt = flow.option(node, connection, "filesFormat", "TEXT").lower()
    options = {}
    if fmt == "csv":
        options = {
            "header": str(flow.option(node, connection, "header", "false")).lower(),
            "sep": flow.option(node, connection, "filesFormatCsvSeperator", ","),
            "inferSchema": str(flow.option(node, connection, "inferSchema", "true")).lower(),
        }
    declared = flow.option(node, connection, "schema")
    return files.read_files(
        flow.spark, connection_path(flow, node, connection), fmt, options, declared, project, where
    )


def land_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    """A drop, or with `from` and `till` (or `months`, up to today) the drops of some months."""
    connection = flow.connection(node.source_connection)
    stamps = node.options.get("srcTimestamp") or []
    path, start, till = connection_path(flow, node, connection), node.options.get("from"), node.options.get("till")
    if node.options.get("months"):
        start, till = landing.recent_months(date.today(), int(node.options["months"]))
    given = dict(
        keys=node.options.get("keyCols") or [],
        src_ts=[stamps] if isinstance(stamps, str) else stamps,
        pattern=node.options.get("srcTimestampFormat", " "),
        zone=node.options.get("srcTimezone", "UTC"),
        cols=landed_names(node.options) or None,
        sep=flow.option(node, connection, "filesFormatCsvSeperator", ","),
        first_file_only=flow.preview,
        open_files=truth(flow.option(node, connection, "openFiles", "false")),
    )
    if start and till:
        return landing.land_initial(flow.spark, path, start, till, **given).rows
    return landing.land_csv(flow.spark, path, **given).rows


def landed_names(options: dict) -> dict[str, str]:
    """The columns of a drop that are chosen, with their new names."""
    return dict(zip(options.get("srcCols") or [], options.get("cols") or []))


def month_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    o = node.options
    ts = (o["srcTimestamp"], o["timestamp"]) if o.get("srcTimestamp") else None
    return files.read_month_partitions(
        flow.spark,
        o["filePath"],
        dict(zip(o["srcCols"], o["cols"])),
        ts,
        o.get("filter", ""),
        o.get("frommonth") or "",
        o.get("till") or "",
        o.get("filesFormat", "avro").lower(),
    )


def json_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    if node.source_connection:
        path = connection_path(flow, node, flow.connection(node.source_connection))
    else:
        path = node.options["filePath"]
    return files.read_files(flow.spark, path, "json")


def events_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    o = node.options
    strict = truth(o.get("strictCompat"))
    return events.to_events(inputs[0], o["keyCols"], o["timestamp_a"], o["timestamp_b"], o["eventTimestamp"], strict_compat=strict)


def join_events_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    o = node.options
    joined = relational.join(inputs[0], inputs[1], o["cols"], o.get("joinType", "inner"))
    return events.to_events(joined, o["keyCols"], o["timestamp_a"], o["timestamp_b"], o["eventTimestamp"])


def push_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    o = node.options
    name = o.get("colName") or o["col"]
    if not truth(o.get("asArray")):
        return columns.push_struct(inputs[0], name, o["cols"])
    bound = int(o["maxItems"]) if o.get("maxItems") else None
    return nesting.push_struct_array(inputs[0], name, o["cols"], bound, o.get("partCol", "part"))


def rule_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    o = node.options
    names = o.get("methodNames") or []
    if o.get("dependenciesFolders"):
        rules.add_dependencies(inputs[0], o["dependenciesFolders"])
    known = dict(flow.functions)
    unknown = [n for n in names if n not in known]
    if unknown and o.get("base64Script"):
        known.update(zip(unknown, rules.load_functions(o["base64Script"], unknown, encoded=True)))
    elif unknown and o.get("paths"):
        script = "\n".join(r[0] for r in flow.spark.read.text(o["paths"], wholetext=True).collect())
        known.update(zip(unknown, rules.load_functions(script, unknown)))
    missing = [n for n in names if n not in known]
    if missing:
        raise FlowError(f"rule functions not registered: {missing}")
    return rules.apply_rules(inputs[0], [known[n] for n in names], o["schema"], o.get("context") or {})


def sub_flow_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    """A flow inside a flow: its open inputs are the signals of this operation's sources."""
    spec = node.options.get("flow") or flow.flows[node.options["flowName"]]
    inner = parse_flow(flow.spark, spec, flow.functions, flow.preview)
    for name, df in zip(node.options.get("inputs") or node.sources, inputs):
        inner._frames[name] = df
    return inner.frame(node.options["output"])


def timed_node(flow: Flow, node: Node, inputs: list[DataFrame]) -> DataFrame:
    """The rows an upstream table gained over a second one, its earlier state."""
    o = node.options
    return incremental.timed_table(inputs[0], inputs[1], o.get("timestamp"), o["till"]).new


OPERATORS: dict[str, Callable[[Flow, Node, list[DataFrame]], Any]] = {
    "reader": read_node,
    "preprocessor": land_node,
    "partitionedAvroSource": month_node,
    "simpleJsonResource": json_node,
    "simpleJsonFile": json_node,
    "tee": lambda f, n, i: relational.tee(i[0], max(len(n.outputs), 1)),
    "split": lambda f, n, i: relational.split(i[0], n.options["expr"], truth(n.options.get("distinct"))),
    "joinToEvents": join_events_node,
    "toEvents": events_node,
    "deDup": lambda f, n, i: events.dedup_oldest(
        i[0], n.options["eventTimestamp"], n.options.get("ignorableCols") or []
    ),
    "pushStruct": push_node,
    "popStruct": lambda f, n, i: columns.pop_struct(i[0], n.options["col"], truth(n.options.get("keepRest"))),
    "explodeArray": lambda f, n, i: columns.explode_array(i[0], n.options["col"], truth(n.options.get("outer"))),
    "freshestRows": lambda f, n, i: events.freshest_rows(i[0], n.options["keyCols"], n.options["timestamp"]),
    "project": lambda f, n, i: columns.project(i[0], projection_of(n.options)),
    "join": lambda f, n, i: relational.join(i[0], i[1], n.options["cols"], n.options.get("joinType", "inner")),
    "union": lambda f, n, i: relational.union(i[0], i[1] if len(i) > 1 else None, truth(n.options.get("byName"))),
    "filter": lambda f, n, i: columns.filter_rows(i[0], predicate_of(n.options)),
    "dropColumns": lambda f, n, i: columns.drop_columns(i[0], n.options["cols"]),
    "withColumn": lambda f, n, i: columns.with_columns(i[0], named_columns(n.options)),
    "withColumns": lambda f, n, i: columns.with_columns(i[0], named_columns(n.options)),
    "withColumnRenamed": lambda f, n, i: columns.rename_column(i[0], n.options["from"], n.options["to"]),
    "ruleScript": rule_node,
    "sort": lambda f, n, i: relational.sort(i[0], n.options.get("cols") or n.options["expr"]),
    "select": lambda f, n, i: columns.select_cols(i[0], n.options["cols"]),
    "limit": lambda f, n, i: relational.limit(i[0], int(n.options.get("rows", 1))),
    "timedTable": timed_node,
    "subFlow": sub_flow_node,
    "sink": lambda f, n, i: i[0],
    "writer": lambda f, n, i: i[0],
    "jsonSink": lambda f, n, i: i[0],
    "eventSink": lambda f, n, i: i[0],
}

SINKS = ("sink", "writer", "jsonSink", "eventSink")


def fill_spec(spec: Any, values: dict[str, str]) -> Any:
    """A spec with each `<NAME>` in its texts replaced by a given value."""
    if isinstance(spec, dict):
        return {k: fill_spec(v, values) for k, v in spec.items()}
    if isinstance(spec, list):
        return [fill_spec(v, values) for v in spec]
    if isinstance(spec, str):
        return re.sub(r"<(\w+)>", lambda m: values.get(m.group(1), m.group(0)), spec)
    return spec


def parse_flow(
    spark: SparkSession,
    spec: dict,
    functions: dict[str, Callable] | None = None,
    preview: bool = False,
) -> Flow:
    """Read a flow in the signal dialect or the older `flows` dialect."""
    connections = {c["id"]: c for c in spec.get("connections") or []}
    nodes = (
        [signal_node(op) for op in spec["operations"]]
        if "operations" in spec
        else [n for op in spec.get("flows") or [] for n in named_nodes(op)]
    )
    return Flow(spark, nodes, connections, functions or {}, spec.get("subFlows") or {}, preview)


def signal_node(op: dict) -> Node:
    signals = op.get("signals") or {}
    sources, outputs = signals.get("sources") or [], signals.get("sinks") or []
    return Node(
        kind=op["operatorType"],
        name=op.get("id") or op.get("name") or (outputs[0].get("signalId", "") if outputs else op["operatorType"]),
        sources=[s["signalId"] for s in sources if s.get("signalId")],
        outputs=[s["signalId"] for s in outputs if s.get("signalId")],
        options=op.get("options") or {},
        source_connection=next((s["connectionId"] for s in sources if s.get("connectionId")), None),
        sink_connection=next((s["connectionId"] for s in outputs if s.get("connectionId")), None),
    )


def named_nodes(op: dict, default_name: str | None = None) -> list[Node]:
    """An operation of the older dialect: `source` is a name, a nested operation, or a list."""
    name = op.get("name") or default_name
    if not name:
        raise FlowError("an operation has no name")
    given = op.get("source", [])
    made: list[Node] = []
    sources = []
    for i, src in enumerate(given if isinstance(given, list) else [given]):
        if isinstance(src, dict):
            inner = named_nodes(src, f"{name}.{i}")
            made += inner
            sources.append(inner[-1].name)
        else:
            sources.append(src)
    options = {k: v for k, v in op.items() if k not in ("name", "type", "source")}
    made.append(
        Node(op["type"], name, sources, [name], {**options, **(op.get("options") or {})}, op.get("connection"), None)
    )
    return made


def build_flow(spark: SparkSession, spec: dict, signal: str, functions: dict[str, Callable] | None = None) -> DataFrame:
    """The lazy DataFrame behind a signal."""
    return parse_flow(spark, spec, functions).frame(signal)


def write_sink(flow: Flow, node: Node, df: DataFrame, batch_id: int | None = None) -> None:
    """Write to the connection of a sink; files of a batch go to a directory of their own."""
    connection = flow.connection(node.sink_connection)
    kind = connection.get("connectionType", "")
    strings = (connection.get("connection") or {}).get("connectionStrings") or {}
    if kind == "jdbc":
        keys = flow.option(node, connection, "keyCols", [])
        name = node.name if truth(flow.option(node, connection, "asContent", "true")) else None
        frame = sinks.jdbc_frame(df, keys, name)
        given = {k: strings[k] for k in ("user", "password", "driver") if strings.get(k)}
        mode = sinks.save_mode(flow.option(node, connection, "saveMode", "append"))
        sinks.write_jdbc(frame, strings["url"], flow.option(node, connection, "table"), mode=mode, options=given)
    elif kind in BUS_KINDS:
        sinks.write_event_bus(df, strings["servers"], flow.option(node, connection, "topic"))
    else:
        fmt = "json" if node.kind == "jsonSink" else flow.option(node, connection, "filesFormat", "parquet")
        options = {}
        if fmt.lower() == "csv":
            options = {
                "header": str(flow.option(node, connection, "header", "true")).lower(),
                "sep": flow.option(node, connection, "filesFormatCsvSeperator", ","),
            }
        path, mode = connection_path(flow, node, connection), flow.option(node, connection, "saveMode")
        if batch_id is not None:
            path, mode = f"{path.rstrip('/')}/batch_id={batch_id}", "overwrite"
        sinks.write_files(
            df,
            path,
            fmt,
            mode,
            options,
            flow.option(node, connection, "codec"),
            flow.option(node, connection, "partitionCols", []),
        )


def run_flow(
    spark: SparkSession, spec: dict, sink: str | None = None, functions: dict[str, Callable] | None = None
) -> list[str]:
    """Write every sink of a flow, or the named one and the side sinks fed by the same rows.

    A frame read by two or more of the sinks is kept while they run. Returns the names of the
    sinks written.
    """
    flow = parse_flow(spark, spec, functions)
    wanted = [n for n in flow.nodes if n.kind in SINKS]
    if sink is not None:
        reached = upstream_signals(flow, sink)
        wanted = [n for n in wanted if sink in (n.name, *n.outputs) or reached & set(n.sources)]
        if not any(sink in (n.name, *n.outputs) for n in wanted):
            raise FlowError(f"no sink named {sink!r}")
    readers: dict[str, int] = {}
    for node in wanted:
        for s in shared_signals(flow, node):
            readers[s] = readers.get(s, 0) + 1
    kept = [s for s, n in readers.items() if n > 1]
    for signal in kept:
        flow._frames[signal] = flow.frame(signal).persist()
    try:
        for node in wanted:
            write_sink(flow, node, flow.frame(node.sources[0]))
    finally:
        for signal in kept:
            flow._frames[signal].unpersist()
    return [n.name for n in wanted]


def pull_flow(
    spark: SparkSession,
    spec: dict,
    sink: str,
    store: incremental.SnapshotStore,
    batch_id: int,
    ts: str | None = None,
    till: str | None = None,
    functions: dict[str, Callable] | None = None,
) -> DataFrame:
    """Write to a sink only the rows its flow gained since the pull before `batch_id`.

    `store` keeps the rows each pull gained, so a pull that is run again compares with the same
    rows, and files it wrote are replaced. The sink is written from there: the flow runs once
    per pull. The first pull loads the history: it is written only when the sink's
    `prefetch.save` option is true. Returns the new rows.
    """
    flow = parse_flow(spark, spec, functions)
    node = next((n for n in flow.nodes if n.kind in SINKS and sink in (n.name, *n.outputs)), None)
    if node is None:
        raise FlowError(f"no sink named {sink!r}")
    current = flow.frame(node.sources[0])
    previous = store.known(before=batch_id)
    first = previous is None
    gained, _ = incremental.new_rows(current, current.limit(0) if first else previous, ts, till)
    fresh = store.save(gained, batch_id)
    if not first or truth((node.options.get("prefetch") or {}).get("save")):
        write_sink(flow, node, fresh, batch_id)
    return fresh


def upstream_signals(flow: Flow, sink: str) -> set[str]:
    """Signals a sink depends on that also leave through a tee or split."""
    found: set[str] = set()
    todo = [s for n in flow.nodes if sink in (n.name, *n.outputs) for s in n.sources]
    while todo:
        signal = todo.pop()
        if signal in found:
            continue
        node = flow.producer(signal)
        found.update(node.outputs if node.kind in ("tee", "split") else [signal])
        todo += node.sources
    return found


def shared_signals(flow: Flow, node: Node) -> set[str]:
    """The signals feeding the nearest tee or split above a sink."""
    todo, found, seen = list(node.sources), set(), set()
    while todo:
        signal = todo.pop()
        if signal in seen:
            continue
        seen.add(signal)
        above = flow.producer(signal)
        if above.kind in ("tee", "split"):
            found.update(above.sources)
        else:
            todo += above.sources
    return found


@dataclass(frozen=True)
class Preview:
    schema: str
    rows: list[dict]
    errors: list[dict]
    count: int | None


def preview(
    spark: SparkSession,
    spec: dict,
    signal: str,
    n: int = 20,
    count: bool = False,
    functions: dict[str, Callable] | None = None,
) -> Preview:
    """Schema and first rows of a signal; nothing is written, and only `n` rows reach the driver."""
    flow = parse_flow(spark, spec, functions, preview=True)
    df = flow.frame(signal)
    errors: list[dict] = []
    if "_error" in df.columns:
        errors = [r.asDict(True) for r in df.filter(F.col("_error").isNotNull()).limit(n).collect()]
        df = df.filter(F.col("_error").isNull()).drop("_error")
    rows = [r.asDict(True) for r in df.limit(n).collect()]
    return Preview(df.schema.json(), rows, errors, df.count() if count else None)


def preview_mapping(spark: SparkSession, spec: dict, topic: str, texts: list[str], n: int = 20) -> Preview:
    """What a mapping makes of some sample messages; its errors are those that are no JSON, and those
    in which a value failed, with the columns that did."""
    sample = spark.createDataFrame([(topic, t) for t in texts], "topic string, value string")
    mapped = mapping.map_documents(sample, spec)
    rows = [r.asDict(True) for r in mapped.rows.limit(n).collect()]
    told = [r.asDict(True) for r in mapped.rejects.limit(n).collect()]
    errors = [r if r["failed"] else {"topic": r["topic"], "value": r["value"]} for r in told]
    return Preview(mapped.rows.schema.json(), rows, errors, None)
