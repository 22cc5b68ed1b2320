"""Exact quantiles of several columns and groups at once by repeated narrowing
(survey E1, E3).

Every wanted rank of every group and column has an interval that holds its value:
at first the column's range in the group.  A round counts the values of each
interval in ``BUCKETS`` equal parts, with each part's least and greatest value, and
keeps the part that the rank falls into.  An interval is done when its least and
greatest value agree.  Counts combine map-side, so a group of any size costs a task
``BUCKETS`` rows a rank, and no buffer holds a group's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.operators.joins import bounded_broadcast, null_safe_join

BUCKETS = 1024


def _long(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, column_name, x): one row a value; nulls and NaN are left out."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                        F.col(c).cast("double").alias("x")) for c in cols]))
    return df.select(*keys, cells).where("x IS NOT NULL AND NOT isnan(x)")


def group_quantiles(df: DataFrame, keys: list[str], cols: list[str], probs: list[float],
                    buckets: int = BUCKETS) -> DataFrame:
    """(keys, column_name, prob, value): linearly interpolated quantiles; a column
    without values in a group has no row."""
    values = _long(df, keys, cols)
    by = [*keys, "column_name"]
    place = [F.struct(F.lit(float(p)).alias("prob"), F.lit(k).alias("upper"),
                      F.least(F.floor(F.lit(float(p)) * (F.col("n") - 1)) + k,
                              F.col("n") - 1).alias("rank")) for p in probs for k in (0, 1)]
    ranges = values.groupBy(*by).agg(F.count("*").alias("n"), F.min("x").alias("lo"),
                                     F.max("x").alias("hi"))
    state = ranges.select("*", F.lit(0).cast("long").alias("below"),
                          F.inline(F.array(*place))).checkpoint(eager=True)
    # Ranks that fall on the same place share an interval.
    spot = [*by, "rank"]
    open_ = state.select(*spot, "lo", "hi", "below").distinct()
    done = open_.where("lo = hi").select(*spot, F.col("lo").alias("value"))
    open_ = open_.where("lo < hi").checkpoint(eager=True)
    while not open_.isEmpty():
        met = null_safe_join(values, bounded_broadcast(open_), by).where("x BETWEEN lo AND hi")
        part = F.least(F.floor((F.col("x") / 2 - F.col("lo") / 2)
                               / (F.col("hi") / 2 - F.col("lo") / 2) * buckets),
                       F.lit(buckets - 1)).cast("int")
        counts = met.groupBy(*spot, "below", part.alias("part")).agg(
            F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        # At most ``buckets`` rows a rank.
        w = Window.partitionBy(*spot).orderBy("part")
        counts = counts.withColumn("upto", F.col("below") + F.sum("n").over(w))
        here = counts.where("rank < upto AND rank >= upto - n").select(
            *spot, "lo", "hi", (F.col("upto") - F.col("n")).alias("below")).checkpoint(eager=True)
        done = done.unionByName(here.where("lo = hi").select(*spot, F.col("lo").alias("value")))
        open_ = here.where("lo < hi")
    found = null_safe_join(state.select(*by, "n", "prob", "upper", "rank"), done, spot)
    low = F.max(F.when(F.col("upper") == 0, F.col("value")))
    high = F.max(F.when(F.col("upper") == 1, F.col("value")))
    at = F.col("prob") * (F.first("n") - 1)
    return found.groupBy(*by, "prob").agg(
        (low + (high - low) * (at - F.floor(at))).alias("value"))
