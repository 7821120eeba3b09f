"""Registry of named queries: key -> (spark builder, optional DuckDB oracle).

A builder takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or data Spark derives from them). The oracle is SQL over the same
tables; keys without one (random or iterative fits) get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco
