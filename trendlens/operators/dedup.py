"""Duplicate analysis and keep-first deduplication (survey W1-W3, A1, A2, T1).

Groups are named by a 256-bit digest of their key columns, so whole texts as
keys stay where they are: exchanges carry 32 bytes a row, and counts and minima
are hash aggregations on fixed-width buffers, combined map-side.  A key that holds
a third of the table costs one row per map task there.  Sizes are joined back
with the hot groups dealt over several tasks (``joins.dealt_join``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.operators.joins import dealt_join
from trendlens.operators.rank import rank_within

_KEY = "__digest"


def key_digest(df: DataFrame, keys: list[str]) -> Column:
    """SHA-256 of key columns of ``df``: lengths keep them apart, and a null differs
    from every value (nulls of one column are equal).  Nested values count as JSON."""
    parts = []
    for k in keys:
        kind = df.schema[k].dataType.simpleString()
        text = (F.to_json(F.struct(k)) if kind.startswith(("array", "struct", "map", "binary"))
                else F.col(k).cast("string"))
        sized = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.when(F.col(k).isNotNull(), sized).otherwise("-"))
    return F.unhex(F.sha2(F.concat_ws(",", *parts), 256))


def group_counts(df: DataFrame, keys: list[str], out: str = "dup_count") -> DataFrame:
    """Rows per group (nulls form one): (digest, ``out``)."""
    return df.select(key_digest(df, keys).alias(_KEY)).groupBy(_KEY).agg(F.count(F.lit(1)).alias(out))


def group_count(df: DataFrame, keys: list[str], out: str = "dup_count") -> DataFrame:
    """The size of each row's group, as a column."""
    counts = group_counts(df, keys, "__n").where(F.col("__n") > 1).checkpoint(eager=True)
    joined = dealt_join(df.withColumn(_KEY, key_digest(df, keys)), counts, _KEY)
    return joined.select(*df.columns, F.coalesce("__n", F.lit(1)).cast("long").alias(out))


def dup_mark(df: DataFrame, keys: list[str], out: str = "is_duplicate") -> DataFrame:
    """Flag every member of a group with more than one row (keep=False)."""
    return group_count(df, keys).withColumn(out, (F.col("dup_count") > 1).cast("int"))


def duplicates_sorted(df: DataFrame, keys: list[str]) -> DataFrame:
    """Members of duplicate groups, sorted by the keys, with group size."""
    return dup_mark(df, keys).filter("is_duplicate = 1").drop("is_duplicate").orderBy(*keys)


def dup_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """A1/A2: one row — rows, groups, duplicate groups and rows, and the number
    of distinct duplicate-group sizes (what the reference logs as 'groups')."""
    g = group_counts(df, keys, "n")
    return g.agg(
        F.sum("n").cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_rows_after_dedup"),
        F.count_if(F.col("n") > 1).cast("long").alias("n_duplicate_groups"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long")
         .alias("n_duplicate_rows"),
        F.count_distinct(F.when(F.col("n") > 1, F.col("n"))).cast("long")
         .alias("n_distinct_group_sizes"),
    )


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of each key group under an explicit order; ties go by
    a hash of all columns, so the survivor does not depend on partitioning.

    Rows get a number and are written once; only digest, order columns, hash and
    number take part in the ranking, and the minimum of (rank, number), packed
    into one decimal, is a hash aggregation.
    """
    rows = df.withColumn("__w3_row", F.monotonically_increasing_id()).checkpoint(eager=True)
    narrow = rows.select(key_digest(df, keys).alias(_KEY), *order,
                         F.xxhash64(*sorted(df.columns)).alias("__w3_tie"), "__w3_row")
    ranked = rank_within(narrow, [], [*order, "__w3_tie", "__w3_row"], out="__w3_rank")
    two_63 = F.lit(str(1 << 63)).cast("decimal(19,0)")
    rank = F.col("__w3_rank").cast("decimal(18,0)")
    packed = ((rank * two_63).cast("decimal(38,0)") + F.col("__w3_row")).cast("decimal(38,0)")
    first = ranked.groupBy(_KEY).agg(F.min(packed).alias("__first"))
    kept = first.select((F.col("__first") % two_63).cast("long").alias("__kept"))
    return rows.join(kept, F.col("__w3_row") == F.col("__kept"), "left_semi").select(*df.columns)
