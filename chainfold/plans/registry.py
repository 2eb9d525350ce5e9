"""Registry of named queries, each with its DuckDB oracle SQL (if any).

A query is a callable ``(spark, sf_dir) -> DataFrame`` over the supplied
test tables. The oracle is an independent SQL statement over the same
tables (views named after them) that must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn`` under ``key``; ``sql`` is its oracle (None: rows-only check)."""

    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"query {key!r} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from chainfold.plans import queries_events, queries_files, queries_labels  # noqa: F401
