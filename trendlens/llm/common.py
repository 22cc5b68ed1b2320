"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.session import scratch_path

#: Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Fixed value: the ASCII white space that separates words.
WHITE = " \t\n\x0b\f\r"
#: Up to this many rows of a written lookup table are broadcast.
BROADCAST_ROWS = 100_000


def text_of(column: str = "text") -> Column:
    """The text, a null taken as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)), F.lit(-1))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back:
    lineage ends there, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], salts: int = 16) -> DataFrame:
    """Left join to a written lookup table with one row per key (nulls equal).

    The table is broadcast when its counted rows stay within
    ``BROADCAST_ROWS``.  Beyond that the join shuffles, and every key is dealt
    over ``salts`` sub-keys so that a hot one does not meet in one task.
    """
    renamed = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    same = None
    for k in keys:
        eq = left[k].eqNullSafe(renamed[f"__k_{k}"])
        same = eq if same is None else same & eq
    if right.count() <= BROADCAST_ROWS:
        out = left.join(F.broadcast(renamed), same, "left")
    else:
        left = left.withColumn("__salt", (F.rand(7) * salts).cast("int"))
        renamed = renamed.withColumn(
            "__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = left.join(renamed, same & (left["__salt"] == renamed["__salt_r"]), "left")
        out = out.drop("__salt", "__salt_r")
    return out.drop(*[f"__k_{k}" for k in keys])


def shipped(spark: SparkSession) -> None:
    """Workers can import the package (for operators called outside a query)."""
    from trendlens.session import prepare
    prepare(spark)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int,
                    modulus: int = 3, held_out: int = 1) -> list[tuple[int, str]]:
    """At most ``per_label`` texts of each label 0 and 1, as (label, text).

    Rows whose crc32 remainder is ``held_out`` are never taken, nor those
    without id, label or document.  The choice follows a hash of the id, so it
    is the same on any cluster; a label row that repeats counts once."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), modulus) != held_out)).distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col("label") == value).orderBy(*order).limit(per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * per_label ids are broadcast.
    found = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    got = found.select("label", "text", F.xxhash64("doc_id").alias("at")).collect()
    return [(r["label"], r["text"]) for r in sorted(got, key=lambda r: (r["at"], r["text"]))]
