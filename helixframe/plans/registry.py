"""The registry that query modules fill."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Modules of this folder that register queries when imported.
MODULES = ("seed_queries", "join_queries", "interval_queries", "aggregate_queries", "kernel_queries", "sequence_queries", "more_queries", "source_queries", "graph_queries")


@dataclass(frozen=True)
class Query:
    """A named query: a Spark plan, and DuckDB SQL for the same rows where SQL can express it."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


_found: dict[str, Query] = {}


def query(*ops: str, sql: str | None = None):
    """Register the decorated (spark, sf_dir) function under its own name."""

    def add(f):
        _found[f.__name__] = Query(f.__name__, f, sql, ops)
        return f

    return add


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"helixframe.plans.{name}")
    return dict(_found)
