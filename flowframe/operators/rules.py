"""User-written row rules.

A rule is a Python function `f(context, row)` over a dict; it returns the changed dict. A
chain of rules runs in one pass over Arrow batches, so a partition is never held whole, and
the output schema is declared rather than guessed from results.
"""

from __future__ import annotations

import base64
import types as pytypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Rule = Callable[[dict, dict], dict]


def apply_rules(
    df: DataFrame,
    funcs: Sequence[Rule],
    schema: T.StructType | str,
    context: dict[str, Any] | None = None,
    error_col: str = "_error",
) -> DataFrame:
    """Run each row through the functions in order.

    A row whose rule fails keeps the values it had before the failing rule, and the failure
    is told in `error_col`; the other rows go on. A value of the wrong type becomes null and is
    told there as well.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    output = T.StructType([*declared.fields, T.StructField(error_col, T.StringType())])
    arrow = to_arrow_schema(output)
    names = declared.fieldNames()
    shared = dict(context or {})
    chain = list(funcs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                error = None
                for rule in chain:
                    try:
                        changed = rule(shared, dict(row))
                        row = row if changed is None else changed
                    except Exception as ex:  # a failing rule must not lose the row
                        error = f"{getattr(rule, '__name__', 'rule')}: {type(ex).__name__}: {ex}"
                        break
                done.append({**{n: row.get(n) for n in names}, error_col: error})
            yield typed_batch(done, arrow, error_col)

    return df.mapInArrow(run, output)


def typed_batch(rows: list[dict], schema: pa.Schema, error_col: str) -> pa.RecordBatch:
    """The rows as a batch; values that don't fit their column become null and are told as errors."""
    try:
        return pa.RecordBatch.from_pylist(rows, schema=schema)
    except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError):
        pass
    for row in rows:
        for field in schema:
            try:
                pa.array([row[field.name]], field.type)
            except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError) as ex:
                told = f"{field.name}: {type(ex).__name__}: {ex}"
                row[field.name] = None
                row[error_col] = f"{row[error_col]}; {told}" if row[error_col] else told
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def load_functions(source: str, names: Sequence[str], encoded: bool = False) -> list[Rule]:
    """Named functions of a script given as text, or as base64 text."""
    text = base64.b64decode(source).decode("utf-8") if encoded else source
    module = pytypes.ModuleType("rule_script")
    exec(compile(text, "rule_script", "exec"), module.__dict__)  # the caller's own script
    missing = [n for n in names if not callable(getattr(module, n, None))]
    if missing:
        raise ValueError(f"script has no function {missing}")
    return [getattr(module, n) for n in names]


def add_dependencies(df: DataFrame, paths: Sequence[str]) -> None:
    """Ship modules that rule functions import to the executors."""
    for p in paths:
        df.sparkSession.sparkContext.addPyFile(p)

