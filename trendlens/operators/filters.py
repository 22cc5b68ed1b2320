"""Row filters and simple projections (survey F1-F6, F10, F11, S3, S4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import scrub_newlines

# The reference's invalid marker and dropped category ids.
BAD_VIDEO_ID = "#NAME?"
DROPPED_CATEGORY_IDS = (29, 15, 19, 30, 43, 44)

# Text cells that the pandas CSV reader turns into missing values.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null")


def not_in(c, values) -> Column:
    """Null-keeping negated membership (pandas ``~isin`` / ``!=`` keep nulls)."""
    col = F.col(c) if isinstance(c, str) else c
    return ~F.coalesce(col.isin(list(values)), F.lit(False))


def drop_values(df: DataFrame, col: str, values) -> DataFrame:
    """drop rows whose ``col`` is one of ``values``; nulls are kept."""
    return df.filter(not_in(col, values))


def impute_const(df: DataFrame, values: dict) -> DataFrame:
    """replace nulls by constants."""
    return df.fillna(values)


def flags_to_int(df: DataFrame, cols: list[str]) -> DataFrame:
    """booleans -> 0/1 integers."""
    return df.select(*[F.col(c).cast("boolean").cast("int").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def drop_noise(df: DataFrame, label: str = "cluster_label") -> DataFrame:
    """drop noise rows (label -1)."""
    return df.filter(F.col(label) != -1)


def threshold(p, cutoff: float = 0.5) -> Column:
    """strict threshold -> 0/1."""
    col = F.col(p) if isinstance(p, str) else p
    return (col > F.lit(cutoff)).cast("int")


def normalize_nulls(df: DataFrame, tokens=NULL_TOKENS, cols: list[str] | None = None) -> DataFrame:
    """S3: turn null tokens in string columns into real nulls."""
    string_cols = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    targets = set(cols) if cols is not None else string_cols
    toks = list(tokens)
    return df.select(*[F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in targets else F.col(c) for c in df.columns])


def scrub_string_columns(df: DataFrame) -> DataFrame:
    """LF / CR -> space in every string cell."""
    return df.select(*[scrub_newlines(c).alias(c) if f.dataType.simpleString() == "string"
                       else F.col(c) for c, f in zip(df.columns, df.schema.fields)])
