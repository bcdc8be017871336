"""All queries of the library by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name; sql: the same rows from DuckDB."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship_event_decisions"](spark, sf_dir)


from cutlight.plans import audit, beats, consolidate, crops, maps, narrative, observe, operations, publish, qa, recovery, reuse, review, semantics, shots, streams, tracks, windows  # noqa: E402, F401
