"""Evaluation metrics as aggregations (survey A5-A7).

Every metric is a small aggregate over (actual, predicted) pairs; the only
shuffle of the input is the (label x label) confusion count, which is
map-side combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """A5: counts per (actual, predicted)."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")) \
             .agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class precision / recall / F1 / support plus 'accuracy',
    'macro avg' and 'weighted avg' rows.  Labels are the union of actual and
    predicted values; zero divisions give 0.  The input is scanned once: the
    confusion counts (at most labels^2 rows) are materialised and every
    per-class and summary row is derived from them."""
    cm = confusion(df, actual, predicted).checkpoint(eager=True)
    per_actual = cm.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"))
    per_pred = cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("n_pred"))
    tp = cm.filter(F.col("actual") == F.col("predicted")) \
           .select(F.col("actual").alias("label"), F.col("n").alias("tp"))
    cls = (per_actual.join(per_pred, "label", "full").join(tp, "label", "left")
           .fillna(0, subset=["support", "n_pred", "tp"]))
    p = _safe_div(F.col("tp").cast("double"), F.col("n_pred"))
    r = _safe_div(F.col("tp").cast("double"), F.col("support"))
    cls = cls.select(F.col("label").cast("string").alias("label"), p.alias("precision"),
                     r.alias("recall"), F.col("support").cast("long").alias("support"),
                     F.col("tp"))
    cls = cls.withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                         F.col("precision") + F.col("recall")))
    tot = cls.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                  F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("label"),
                     (F.col("tp") / F.col("n")).alias("precision"),
                     (F.col("tp") / F.col("n")).alias("recall"),
                     F.col("n").cast("long").alias("support"),
                     (F.col("tp") / F.col("n")).alias("f1"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("n").cast("long").alias("support"),
                       F.col("mf").alias("f1"))
    weighted = tot.select(F.lit("weighted avg").alias("label"),
                          (F.col("wp") / F.col("n")).alias("precision"),
                          (F.col("wr") / F.col("n")).alias("recall"),
                          F.col("n").cast("long").alias("support"),
                          (F.col("wf") / F.col("n")).alias("f1"))
    return cls.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MSE, R^2 = 1 - SSE/SST, MAE, RMSE in one pass (one row)."""
    y = F.col(actual).cast("double")
    e = y - F.col(predicted).cast("double")
    agg = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                 F.sum(e * e).alias("sse"), F.var_pop(y).alias("vy"),
                 F.count(F.lit(1)).alias("n"))
    r2 = F.when(F.col("vy") == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) - F.col("sse") / (F.col("vy") * F.col("n")))
    return agg.select(F.col("mse").alias("mean_squared_error"), r2.alias("r2_score"),
                      F.col("mae").alias("mean_absolute_error"),
                      F.sqrt("mse").alias("root_mean_squared_error"))
