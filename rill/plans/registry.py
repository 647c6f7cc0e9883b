"""Registry of named queries and their independent SQL answers.

``@query(name, sql=...)`` records a ``(spark, sf_dir) -> DataFrame`` callable
and, when the result can be written as plain SQL, the DuckDB text that
computes the same rows from the same parquet tables.  ``sql=None`` marks an
iterative or model-based query whose check is done in pytest instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register
