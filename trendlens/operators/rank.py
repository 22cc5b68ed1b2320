"""Skew-safe global ranking.

A window ``row_number() OVER (PARTITION BY k ORDER BY o)`` puts every row of
one key into one task; a key holding a third of the table would then sort a
third of the table on one core.  ``rank_within`` instead range-partitions on
``(k, o)`` — a hot key is spread over many partitions — numbers rows inside
each range partition, and adds the counts of the same key in all earlier
partitions (a small table: at most partitions x keys rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rank_within(df: DataFrame, partition_cols: list[str], order_cols: list,
                out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """1-based ``row_number`` of ``order_cols`` inside each ``partition_cols``
    group, computed without a per-group task.

    ``order_cols`` must make a total order inside a group (add a unique id).
    The range-partitioned data is checkpointed so both uses — local numbering
    and the per-partition counts — see the same partition boundaries, and a
    lost executor recomputes from the checkpoint, not the whole lineage.
    """
    n = num_partitions or _num_partitions(df)
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(c) for c in partition_cols] + ordered
    local_w = Window.partitionBy("__pid", *partition_cols).orderBy(*ordered)
    ranged = (df.repartitionByRange(n, *keys)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__lr", F.row_number().over(local_w))
                .checkpoint(eager=True))
    counts = ranged.groupBy("__pid", *partition_cols).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*partition_cols).orderBy("__pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", *partition_cols,
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    from trendlens.operators.joins import null_safe_join
    joined = null_safe_join(ranged, offsets, ["__pid", *partition_cols])
    return (joined.withColumn(out, (F.col("__off") + F.col("__lr")).cast("long"))
                  .drop("__pid", "__lr", "__off"))


def dense_index(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """0-based index of each distinct value of ``col`` in ascending order
    (a distributed ``dense_rank() - 1`` over the distinct values)."""
    out = out or f"{col}_encoded"
    distinct = df.select(col).distinct()
    return rank_within(distinct, [], [col], out=out).select(col, (F.col(out) - 1).alias(out))
