"""Partition sizing helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy per-row work over all cores.

    A scan yields one task per file split; a small or single-row-group file
    is one task, and regex or tokenisation work on it would run on one core.
    When the input has fewer partitions than the cluster's default
    parallelism, hash-repartition by ``keys`` (round-robin when none);
    otherwise — the normal case for large inputs — return ``df`` unchanged,
    so no shuffle is added at scale.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
