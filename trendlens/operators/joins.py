"""Lookup joins with a checked broadcast (survey J1, J5, F7-F9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when it provably holds at most so many rows and
# bytes (of its values as text); above either the join stays a shuffle join (AQE
# may still pick a broadcast from run-time sizes).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20
#: In a dealt join a key is hot if it has more than one in so many rows.
HOT_SHARE = 2000


def small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
          max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.  One job
    over ``limit(max_rows + 1)``, which stops reading beyond the bound on rows."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(max_rows + 1).select(size.alias("b")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return seen["n"] <= max_rows and seen["b"] <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after proving that ``df`` is small."""
    return F.broadcast(df) if small(df, max_rows, max_bytes) else df


def dealt_join(df: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Left join to ``sizes`` (one row per ``key``, with ``__n``: the rows of ``df``
    that have it).  The rows of a hot key are dealt over several tasks, each of
    which gets the key's row; there are at most ``HOT_SHARE`` hot keys, and only
    their names and shares are broadcast.  ``__n`` stays, ``key`` is kept once."""
    total = sizes.agg(F.sum("__n")).first()[0] or 1
    pieces = F.ceil(F.col("__n") * HOT_SHARE / F.lit(total)).cast("int")
    sizes = sizes.withColumn("__pieces", pieces)
    hot = sizes.where(F.col("__pieces") > 1).select(F.col(key).alias("__hot"), "__pieces")
    dealt = df.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    # A row's place in its partition deals the rows of a hot key.
    piece = F.pmod(F.monotonically_increasing_id(), F.coalesce("__pieces", F.lit(1))).cast("int")
    dealt = dealt.withColumn("__piece", piece).drop("__hot", "__pieces")
    copies = sizes.withColumn("__p", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1)))
    copies = copies.withColumnRenamed(key, "__k").drop("__pieces")
    same = (F.col(key) == F.col("__k")) & (F.col("__piece") == F.col("__p"))
    return dealt.join(copies, same, "left").drop("__k", "__p", "__piece")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (pandas group semantics).

    The right side's key columns are dropped from the output.
    """
    r = right
    renamed = {}
    for k in keys:
        nk = f"__r_{k}"
        r = r.withColumnRenamed(k, nk)
        renamed[k] = nk
    cond = [left[k].eqNullSafe(r[renamed[k]]) for k in keys]
    out = left.join(r, on=cond, how=how)
    return out.drop(*renamed.values())


def with_lookup(df: DataFrame, lookup: DataFrame, keys: list[str],
                how: str = "left", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Many-to-one lookup; a missing key yields nulls (``how='left'``)."""
    return df.join(bounded_broadcast(lookup, max_broadcast_rows), on=keys, how=how)


def attach_details(pairs: DataFrame, items: DataFrame, key_left: str, key_right: str,
                   columns: list[str]) -> DataFrame:
    """Add item columns to neighbour rows, keeping every neighbour row."""
    it = items.select(F.col(key_right).alias(key_left), *columns)
    return pairs.join(it, on=key_left, how="inner")


def lookup_items(df: DataFrame, query_ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """rows whose id is requested, and the requested ids that do not exist."""
    q = query_ids.select(key).distinct()
    found = df.join(q, on=key, how="left_semi")
    missing = q.join(df.select(key), on=key, how="left_anti")
    return found, missing


def lookup_rows(df: DataFrame, positions: DataFrame, row_col: str,
                position_col: str) -> tuple[DataFrame, DataFrame]:
    """F8: the rows at the requested 0-based positions, and the positions that
    are out of range (null, negative or past the last row)."""
    q = positions.select(F.col(position_col).alias("__p")).distinct()
    found = df.join(q, df[row_col] == q["__p"], "left_semi")
    bad = q.join(df.select(row_col), q["__p"] == F.col(row_col), "left_anti")
    return found, bad.select(F.col("__p").alias(position_col))
