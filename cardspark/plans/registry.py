"""Registry of named queries and their DuckDB oracle twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardspark.plans.oracle import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None, extra_ctes=None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is the SQL body run by DuckDB after the fixture CTEs; leave it
    out for operators that are not SQL-expressible (rows-only check).
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = with_fixtures(oracle, extra_ctes)
        return fn
    return deco
