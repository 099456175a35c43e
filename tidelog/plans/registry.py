"""Registry of the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query, with the SQL that must give the same rows."""

    def add(fn: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load() -> tuple[dict[str, Run], dict[str, str]]:
    from tidelog.plans import (  # noqa: F401
        apply_queries, catalog_queries, feed_queries, function_queries, relational_queries,
        source_queries, stream_queries, table_queries,
    )

    return QUERIES, ORACLES
