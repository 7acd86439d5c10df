"""Registered queries: one or more per operator, each over whole tables.

`QUERIES` maps a name to a function (spark, data directory) -> DataFrame. `ORACLE` holds the
same result as SQL over the same tables, where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODULES = (
    "columns",
    "relational",
    "events",
    "incremental",
    "sources",
    "sinks",
    "mapping",
    "expressions",
    "cells",
    "orders",
    "intervals",
    "days",
    "landing",
    "rules",
    "streaming",
    "flows",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL twin where there is one."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


def load_all() -> None:
    for module in MODULES:
        import_module(f"flowframe.catalog.{module}")
