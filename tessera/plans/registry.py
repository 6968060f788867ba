"""Registry of named queries and their independent SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``; the oracle is plain SQL
over the driver tables (views ``region`` … ``conversations``) that DuckDB
runs as an independent check.  Column names are aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import prepare, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco
