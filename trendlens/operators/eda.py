"""Exploratory summaries (survey E1-E7), all as single-pass aggregations.

Quantiles: ``exact=True`` gives linearly interpolated ones, like pandas, by repeated
narrowing (``quantiles.py``) or distributed ranks; the default is
``percentile_approx``.  Neither holds a group's values in one buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.operators.joins import null_safe_join
from trendlens.operators.quantiles import group_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def summary_stats(df: DataFrame, cols: list[str], exact: bool = False,
                  accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column (long form)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        if not exact:
            aggs.append(F.percentile_approx(x, list(QUARTILES), accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    if exact:
        # Three numbers a column.
        at = {(r["column_name"], r["prob"]): r["value"]
              for r in group_quantiles(df, [], cols, list(QUARTILES)).collect()}
        wide = wide.select("*", *[F.array(*[F.lit(at.get((c, p))).cast("double")
                                            for p in QUARTILES]).alias(f"{c}__q") for c in cols])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").cast("long").alias("count"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                     F.col(f"{c}__min").alias("min"),
                     F.col(f"{c}__q")[0].alias("q25"), F.col(f"{c}__q")[1].alias("q50"),
                     F.col(f"{c}__q")[2].alias("q75"), F.col(f"{c}__max").alias("max"))
            for c in cols]
    return long_rows(wide, rows)


def long_rows(wide: DataFrame, rows: list) -> DataFrame:
    """One aggregated row -> one row per struct, without a union (a union of
    projections would let each branch re-run its own scan)."""
    return wide.select(F.inline(F.array(*rows)))


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (i < j), one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
                    .alias(f"{a}__{b}") for a, b in pairs])
    return long_rows(wide, [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                     F.col(f"{a}__{b}").alias("corr")) for a, b in pairs])


def category_perf(df: DataFrame, keys: list[str], measures: list[str],
                  exact_median: bool = False, accuracy: int = 10000) -> DataFrame:
    """Per-group row count, mean and median of each measure."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        x = F.col(m).cast("double")
        aggs.append(F.avg(x).alias(f"avg_{m}"))
        if not exact_median:
            aggs.append(F.percentile_approx(x, 0.5, accuracy).cast("double").alias(f"median_{m}"))
    out = df.groupBy(*keys).agg(*aggs)
    if not exact_median:
        return out
    medians = group_quantiles(df, keys, measures, [0.5]).groupBy(*keys).agg(*[
        F.max(F.when(F.col("column_name") == m, F.col("value"))).alias(f"median_{m}")
        for m in measures])
    return null_safe_join(out, medians, keys, "left")


def value_range(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(F.col(col).cast("double")).alias("lo"),
               F.max(F.col(col).cast("double")).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, col: str, bins: int = 10,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed)."""
    if lo is None or hi is None:
        lo, hi = value_range(df, col)
    width = (hi - lo) if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width) * F.lit(bins)), F.lit(bins - 1))
    return (df.filter(x.isNotNull()).groupBy(b.cast("long").alias("bucket"))
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("bucket_lo", F.lit(lo) + F.col("bucket") * F.lit(width / bins))
              .withColumn("bucket_hi", F.lit(lo) + (F.col("bucket") + 1) * F.lit(width / bins)))


def exact_quantiles(df: DataFrame, col: str, probs: tuple) -> list[float]:
    """Linearly interpolated quantiles from a distributed ranking: only the
    rows at the needed ranks are read back, no task holds all values."""
    from trendlens.operators.rank import rank_within
    values = df.select(F.col(col).cast("double").alias("x")).where("x IS NOT NULL")
    ranked = rank_within(values, [], ["x"], out="__rank")
    n = ranked.count()
    if not n:
        return [None] * len(probs)
    places = [p * (n - 1) for p in probs]
    wanted = sorted({int(p) + 1 + k for p in places for k in (0, 1) if int(p) + k < n})
    at = {r["__rank"]: r["x"] for r in ranked.where(F.col("__rank").isin(wanted)).collect()}
    out = []
    for p in places:
        low = at[int(p) + 1]
        high = at.get(int(p) + 2, low)
        out.append(low + (high - low) * (p - int(p)))
    return out


def iqr_fences(df: DataFrame, col: str, k: float = 1.5, exact: bool = False,
               accuracy: int = 10000) -> tuple[float, float]:
    if exact:
        q = exact_quantiles(df, col, (0.25, 0.75))
    else:
        q = df.agg(F.percentile_approx(F.col(col).cast("double"), [0.25, 0.75], accuracy)
                   .alias("q")).first()["q"]
    iqr = q[1] - q[0]
    return q[0] - k * iqr, q[1] + k * iqr


def clip_to(c, fences: tuple[float, float]):
    """E5: a value clipped to its IQR fences [q1 - k*IQR, q3 + k*IQR]."""
    return F.least(F.greatest(F.col(c).cast("double"), F.lit(fences[0])), F.lit(fences[1]))


def clip_outliers(df: DataFrame, cols: list[str], k: float = 1.5, exact: bool = False,
                  accuracy: int = 10000, suffix: str = "_clipped") -> DataFrame:
    """E5 on several columns."""
    return df.withColumns({c + suffix: clip_to(c, iqr_fences(df, c, k, exact, accuracy))
                           for c in cols})


def length_vs_perf(df: DataFrame, length_col: str, measures: list[str],
                   bucket_width: int = 1000) -> DataFrame:
    """Bucket a text length and average the measures per bucket."""
    b = (F.floor(F.col(length_col) / bucket_width) * bucket_width).cast("long")
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(F.col(m).cast("double")).alias(f"avg_{m}")
                                             for m in measures]
    return df.groupBy(b.alias("length_bucket")).agg(*aggs)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column (long form), one aggregation."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot(["__n"], df.columns, "column_name", "n_null")
    return long.select("column_name", F.col("n_null").cast("long").alias("n_null"),
                       F.col("__n").cast("long").alias("n_rows"))
