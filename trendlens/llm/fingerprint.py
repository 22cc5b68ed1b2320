"""Homomorphic multiset fingerprints of documents (operator 9), native functions.

Every paragraph (a text's pieces between line breaks) hashes to a wide vector:
32 lanes of 32 bits from SHA-256, and 128 signed lanes to which each of its
sentences adds +1 or -1 in one place.  A document's fingerprint is the sum of
its paragraphs' vectors, modulo 2^32 and 2^16.  So it depends on the multiset
of paragraphs and not on their order, and a paragraph is put in or taken out by
adding or subtracting its vector (``combine``; ``update`` does so to a stored
fingerprint).  The signed lanes estimate how
many sentences two documents share, whatever their number.

Edge cases: a null text is an empty one, which has one empty paragraph; texts
with the same multiset of paragraphs have equal fingerprints; rows that repeat
an id follow one another in the order of a hash of their texts; rows without an
id come before all others; the neighbour of an only document is itself; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import text_of

DENSE, SIGNED = 32, 128
MOD_DENSE, MOD_SIGNED = 1 << 32, 1 << 16
#: Fixed value: sentences are runs of characters other than these.
SENTENCE = r"[^.!?\n]+"


def _signed(x: Column) -> Column:
    """``x`` modulo 2^16, from -2^15 to 2^15 - 1."""
    half = MOD_SIGNED >> 1
    return F.pmod(x + half, F.lit(MOD_SIGNED)) - half


def add_fingerprint(df: DataFrame, text: str, dense: str, signed: str) -> DataFrame:
    """Adds the two lane arrays of a non-null text column."""
    hashed = F.transform(F.split(F.col(text), "\n", -1), lambda p: F.concat(
        *[F.sha2(F.concat(F.lit(f"{k}:"), p), 256) for k in range(DENSE // 8)]))
    marks = F.transform(F.regexp_extract_all(F.col(text), F.lit(SENTENCE), F.lit(0)),
                        lambda s: F.concat(F.lit(" "), F.substring(F.md5(s), 1, 2)))
    df = df.withColumns({"__hashed": hashed, "__marks": F.array_join(marks, "")})
    h, m = F.col("__hashed"), F.col("__marks")

    def lane(j: Column) -> Column:
        part = F.aggregate(h, F.lit(0).cast("long"), lambda a, x: a + F.conv(
            F.substr(x, j * 8 + 1, F.lit(8)), 16, 10).cast("long"))
        return F.pmod(part, F.lit(MOD_DENSE))

    def times(code: Column) -> Column:
        mark = F.concat(F.lit(" "), F.lpad(F.lower(F.hex(code)), 2, "0"))
        return (F.length(m) - F.length(F.replace(m, mark, F.lit("")))) / 3

    def net(j: Column) -> Column:
        return _signed((times(j) - times(j + SIGNED)).cast("long"))

    # Naming each staged column twice keeps it evaluated once a row, not once a lane.
    return (df.withColumn(dense, F.when(F.size(h) > 0, F.transform(
                F.sequence(F.lit(0), F.lit(DENSE - 1)), lane)))
            .withColumn(signed, F.when(F.length(m) >= 0, F.transform(
                F.sequence(F.lit(0), F.lit(SIGNED - 1)), net)))
            .drop("__hashed", "__marks"))


def combine(a: Column, b: Column, sign: int = 1, signed: bool = False) -> Column:
    """Dense, or ``signed``, lanes of a document with paragraphs put in (1) or
    taken out (-1)."""
    return F.zip_with(a, b, lambda x, y: _signed(x + sign * y) if signed
                      else F.pmod(x + sign * y, F.lit(MOD_DENSE)))


def lanes_of(fingerprint: Column) -> tuple[Column, Column]:
    """Dense and signed lanes of a fingerprint text (``as_text``)."""
    def lanes(n: int, first: int, digits: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.conv(
            F.substr(fingerprint, j * digits + first, F.lit(digits)), 16, 10).cast("long"))

    return lanes(DENSE, 1, 8), F.transform(lanes(SIGNED, 8 * DENSE + 1, 4), _signed)


def update(df: DataFrame, paragraphs: str, sign: int = 1,
           fingerprint: str = "fingerprint") -> DataFrame:
    """``df`` with the lines of ``paragraphs`` put in (1) or taken out (-1) of the
    stored ``fingerprint``, without the document's text.  Where ``paragraphs`` is
    null the fingerprint stays."""
    columns = df.columns
    dense, signed = lanes_of(F.col(fingerprint))
    df = add_fingerprint(df, paragraphs, "__dp", "__sp")
    df = df.withColumns({"__d": combine(dense, F.col("__dp"), sign),
                         "__s": combine(signed, F.col("__sp"), sign, True)})
    new = F.when(F.col(paragraphs).isNotNull(), as_text("__d", "__s")).otherwise(
        F.col(fingerprint))
    return df.withColumn(fingerprint, new).select(*columns)


def as_text(dense: str, signed: str) -> Column:
    """The fingerprint as hexadecimal text: 8 digits a dense lane, 4 a signed one."""
    parts = [F.transform(F.col(dense), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")),
             F.transform(F.col(signed), lambda x: F.lpad(F.lower(F.hex(
                 F.pmod(x, F.lit(MOD_SIGNED)))), 4, "0"))]
    return F.array_join(F.concat(*parts), "")


def likeness(dense_a: str, signed_a: str, dense_b: str, signed_b: str) -> Column:
    """Cosine of the signed lanes, from 0 to 1; 1 for equal fingerprints."""
    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0).cast("long"),
                           lambda a, p: a + p)

    norm = F.sqrt(dot(signed_a, signed_a).cast("double") * dot(signed_b, signed_b).cast("double"))
    cosine = F.coalesce(F.try_divide(dot(signed_a, signed_b).cast("double"), norm), F.lit(0.0))
    same = (F.col(dense_a) == F.col(dense_b)) & (F.col(signed_a) == F.col(signed_b))
    return F.when(same, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a ``fingerprint`` column."""
    df = add_fingerprint(docs.withColumn("__text", text_of(text)), "__text", "__d", "__s")
    return df.withColumn("fingerprint", as_text("__d", "__s")).drop("__text", "__d", "__s")


def in_order(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``docs`` (doc_id, __text) cut into ranges of ids, and the window in which
    ``lead`` gives the next document.

    Each range also holds a guest copy of the next range's first document, so
    no range needs another one's rows.  The limits come from a mergeable
    quantile sketch of the ids; there are four ranges a shuffle partition.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = F.percentile_approx("doc_id", [i / n for i in range(1, n)], F.lit(20 * n))
    limits = sorted(set(docs.agg(sketch.alias("q")).first()["q"] or []))
    limits = F.array(*[F.lit(x) for x in limits]).cast("array<long>")
    ranged = docs.withColumn("__range", F.size(F.filter(limits, lambda x: x <= F.col("doc_id"))))
    firsts = ranged.groupBy("__range").agg(F.min("doc_id").alias("__first"))
    by_range = Window.orderBy("__range")
    before = F.coalesce(F.lag("__range").over(by_range), F.max("__range").over(
        by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(before.alias("__before"), "__first")
    # One row a range: the count of ranges bounds what is broadcast.
    guests = docs.join(F.broadcast(firsts), F.col("doc_id") == F.col("__first"))
    guests = guests.select(*docs.columns, F.col("__before").alias("__range"),
                           F.lit(True).alias("__guest"))
    rows = ranged.withColumn("__guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("__range").orderBy("__guest", "doc_id", "__tie")
    return rows.withColumn("__tie", F.xxhash64("__text")), order


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text (its last quarter
    replaced by the start of the next document), and how alike its fingerprint
    is to the edited one and to the next document's."""
    rows, order = in_order(docs.select("doc_id", text_of().alias("__text")))
    rows = rows.withColumn("__next", F.coalesce(F.lead("__text").over(order), F.lit("")))
    t, nxt = F.col("__text"), F.col("__next")
    cut = F.floor(F.length(t) / 4).cast("int")
    rows = rows.withColumn("__edited", F.concat(F.substr(t, F.lit(1), F.length(t) - cut),
                                                F.substr(nxt, F.lit(1), cut)))
    rows = add_fingerprint(rows.drop("__next"), "__text", "__d", "__s")
    after = {"__dn": F.lead("__d").over(order), "__sn": F.lead("__s").over(order)}
    rows = rows.withColumns(after).where(~F.col("__guest"))
    rows = add_fingerprint(rows, "__edited", "__de", "__se")
    return rows.select(
        "doc_id", F.length("__text").cast("long").alias("n_chars"),
        F.sha2("__edited", 256).alias("edited_sha256"),
        as_text("__d", "__s").alias("fingerprint"),
        as_text("__de", "__se").alias("edited_fingerprint"),
        likeness("__d", "__s", "__de", "__se").alias("near_edited"),
        F.coalesce(likeness("__d", "__s", "__dn", "__sn"), F.lit(0.0)).alias("near_next"))
