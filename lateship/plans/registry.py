"""The query catalogue: name -> Spark plan, and name -> DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame``. Queries that SQL can
express register their oracle next to them; the others (model fits, random
samples) register none and are checked by row count and unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (q_profile, q_clean, q_geo, q_features, q_evaluate,  # noqa: F401
                   q_io, q_models, q_stream)
