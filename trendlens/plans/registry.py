"""Name -> (Spark query, oracle SQL) registry used by ``__spark_entry__``."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is the
    DuckDB statement over the same tables that must give the same rows."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from trendlens.session import prepare
            return fn(prepare(spark), sf_dir)
        run.__name__ = getattr(fn, "__name__", name)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """Read a driver table; ``spread_by`` hash-spreads CPU-heavy inputs over
    all cores when the scan yields fewer partitions than cores (a no-op on
    large inputs)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread_by:
        from trendlens.operators.partitioning import ensure_parallelism
        df = ensure_parallelism(df, spread_by)
    return df
