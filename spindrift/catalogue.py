"""Queries of the library's own operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Registers a query and, where SQL can express it, its SQL."""

    def register(f):
        _QUERIES[name] = (f, sql)
        return f

    return register


def _load() -> None:
    from spindrift.plans import demos, record_queries, source_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: f for k, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: sql for k, (_, sql) in _QUERIES.items() if sql}
