"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapengine.functions.columns import round_doubles
from lapengine.session import limit_method_size

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; doubles are rounded for comparison."""
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            limit_method_size(spark)
            return round_doubles(_fn(spark, sf_dir))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that all registrations run."""
    from lapengine.plans import queries, queries_linear, queries_ml, queries_tables  # noqa: F401
