"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables (or data
Spark derives from them).  Its oracle, when the semantics are expressible in
SQL, is an independent SQL text over the same tables.
"""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tidewell.plans import (batch_queries, gold, merge_queries, quality_queries,  # noqa: F401
                                stream_queries, version_queries, pipeline_queries, sink_queries, growth_queries,
                                retention_queries)
