"""TF-IDF with a top-N vocabulary (survey M3, A4, T2).

Semantics: tokens are words of two or more characters, raw term counts,
``idf = ln((1 + n_docs) / (1 + df)) + 1``, rows L2-normalised, vocabulary =
the ``max_features`` terms with the highest corpus frequency (ties: term
ascending), indexed alphabetically.

* Statistics: a document is one row, so its terms and its distinct terms are
  counted where it lies and one aggregation by term, combined map-side, moves a row
  per task and term; only rows that repeat a document's id meet by (doc, term).
* Top-N: ``orderBy(...).limit(N)`` plans as a TakeOrderedAndProject — each
  task keeps N rows, so the vocabulary never needs a full sort.
* Weights (long form) join the bounded vocabulary by broadcast (N rows,
  proven by construction); a document's row group is at most N terms.
* Several fields at once (``tfidf_parts``): each row's vectors from its own words.
* Vector form: ``CountVectorizerModel.from_vocabulary`` + ``ElementwiseProduct``
  (idf) + ``Normalizer`` — sparse vectors, all JVM-side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer,
                                SQLTransformer)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.patterns import MIN_TOKEN_LEN
from trendlens.functions.text import tokens as token_filter

MAX_FEATURES = 10000


def doc_terms(df: DataFrame, id_col: str, words_col: str) -> DataFrame:
    """(doc, term, cnt): raw counts of the vectoriser tokens of each document."""
    t = df.select(F.col(id_col).alias("doc"), F.explode(token_filter(words_col)).alias("term"))
    return t.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("cnt"))


def term_stats(terms: DataFrame) -> DataFrame:
    """A4: corpus term frequency and document frequency per term."""
    return terms.groupBy("term").agg(F.sum("cnt").cast("long").alias("tf"),
                                     F.count(F.lit(1)).cast("long").alias("df"))


def corpus_stats(df: DataFrame, id_col: str, words_col: str) -> DataFrame:
    """``term_stats`` of ``doc_terms``: a document that is one row counts each of its
    terms once without (doc, term) rows being moved; ids that repeat are put
    together first."""
    ids = df.groupBy(F.col(id_col).alias("__id")).agg(F.count("*").alias("__n"))
    repeated = ids.where("__n > 1").select("__id").checkpoint(eager=True)
    single, parts = df, []
    if not repeated.isEmpty():
        same = F.col(id_col).eqNullSafe(F.col("__id"))
        single = df.join(repeated, same, "left_anti")
        parts = [term_stats(doc_terms(df.join(repeated, same, "left_semi"), id_col, words_col))]
    single, tokens = single.select(token_filter(words_col).alias("__tokens")), F.col("__tokens")
    once = F.transform(F.array_distinct(tokens), lambda w: F.struct(
        w.alias("term"), F.lit(0).cast("long").alias("tf"), F.lit(1).cast("long").alias("df")))
    each = F.transform(tokens, lambda w: F.struct(
        w.alias("term"), F.lit(1).cast("long").alias("tf"), F.lit(0).cast("long").alias("df")))
    parts.append(single.select(F.inline(F.concat(each, once))))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


@dataclass
class TfidfVocab:
    table: DataFrame        # term, term_index, tf, df, idf
    n_docs: int

    def terms(self) -> list[str]:
        """Vocabulary in index order (at most ``max_features`` strings)."""
        return [r["term"] for r in self.table.orderBy("term_index").select("term").collect()]

    def idf(self) -> list[float]:
        return [r["idf"] for r in self.table.orderBy("term_index").select("idf").collect()]


def fit_vocab(df: DataFrame, id_col: str, words_col: str,
              max_features: int = MAX_FEATURES, terms: DataFrame | None = None) -> TfidfVocab:
    """T2 + idf: choose the vocabulary and its idf weights.  ``terms`` may be
    a materialised ``doc_terms`` table shared with ``tfidf_long``."""
    n_docs = df.count()
    stats = corpus_stats(df, id_col, words_col) if terms is None else term_stats(terms)
    top = stats.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    # At most max_features rows: a single ordered window is bounded here.
    idx = top.withColumn("term_index", (F.row_number().over(Window.orderBy("term")) - 1)
                         .cast("long"))
    idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    table = idx.select("term", "term_index", "tf", "df", idf.alias("idf")).checkpoint(eager=True)
    return TfidfVocab(table, n_docs)


def tfidf_long(df: DataFrame, id_col: str, words_col: str, vocab: TfidfVocab,
               terms: DataFrame | None = None) -> DataFrame:
    """(doc, term, term_index, weight) for vocabulary terms of each document."""
    terms = terms if terms is not None else doc_terms(df, id_col, words_col)
    v = F.broadcast(vocab.table.select("term", "term_index", "idf"))
    w = terms.join(v, "term").select("doc", "term", "term_index",
                                     (F.col("cnt") * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc")))
    return w.select(F.col("doc").alias(id_col), "term", "term_index",
                    (F.col("raw") / norm).alias("weight"))


def vector_stages(words_col: str, vocab: TfidfVocab, out: str) -> list:
    """The fitted vectoriser as MLlib stages from a word list to a sparse vector:
    a ``PipelineModel`` of them (and whatever follows) saves and loads as one."""
    tok, tf, weighted = f"__tok_{out}", f"__tf_{out}", f"__w_{out}"
    return [
        SQLTransformer(statement=f"SELECT *, filter(`{words_col}`, w -> length(w) >= "
                                 f"{MIN_TOKEN_LEN}) AS `{tok}` FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(vocab.terms(), inputCol=tok, outputCol=tf),
        ElementwiseProduct(scalingVec=DenseVector(vocab.idf()), inputCol=tf, outputCol=weighted),
        Normalizer(p=2.0, inputCol=weighted, outputCol=out),
        SQLTransformer(statement=f"SELECT * EXCEPT (`{tok}`, `{tf}`, `{weighted}`) FROM __THIS__")]


def tfidf_vectors(df: DataFrame, words_col: str, vocab: TfidfVocab, out: str) -> DataFrame:
    """Sparse TF-IDF vector column ``out`` (index = alphabetical vocabulary)."""
    return PipelineModel(stages=vector_stages(words_col, vocab, out)).transform(df)


def save_vocab(vocab: TfidfVocab, path: str) -> str:
    """The vocabulary with its idf weights and the number of documents."""
    vocab.table.withColumn("n_docs", F.lit(vocab.n_docs).cast("long")).write.parquet(path)
    return path


def load_vocab(spark: SparkSession, path: str) -> TfidfVocab:
    """What ``save_vocab`` wrote, ready for ``tfidf_vectors`` and ``tfidf_long``.
    A vocabulary without terms has no documents to speak of."""
    table = spark.read.parquet(path)
    first = table.select("n_docs").first()
    return TfidfVocab(table.drop("n_docs"), first["n_docs"] if first else 0)


def sparse_parts(df: DataFrame, *cols: str) -> DataFrame:
    """Sparse vector columns as ``<col>_idx`` and ``<col>_val`` arrays of their
    non-zero entries.  A vector is stored as a struct that holds both, so whole
    Arrow columns are handed on and nothing of the vocabulary's width is made."""
    others = [c for c in df.columns if c not in cols]
    parts = [f"{c}_{part}" for c in cols for part in ("idx", "val")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.columns[len(others):]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(others)]
                + [v.field(part) for v in vectors for part in ("indices", "values")],
                names=[*others, *parts])

    schema = T.StructType([df.schema[c] for c in others] + [
        T.StructField(part, T.ArrayType(T.IntegerType() if k % 2 == 0 else T.DoubleType()))
        for k, part in enumerate(parts)])
    return df.select(*others, *cols).mapInArrow(run, schema)


def tfidf_parts(df: DataFrame, words_cols: list[str], vocabs: dict) -> DataFrame:
    """Word-list columns replaced by their TF-IDF vectors, as ``<col>_tfidf_idx`` and
    ``<col>_tfidf_val``.  A row's vectors are made where it lies: no (doc, term) rows."""
    known = [c for c in words_cols if not vocabs[c].table.isEmpty()]
    for c in known:
        df = tfidf_vectors(df, c, vocabs[c], f"{c}_tfidf")
    df = sparse_parts(df.drop(*words_cols), *[f"{c}_tfidf" for c in known])
    # Without a single term there are no entries.
    return df.withColumns({f"{c}_tfidf_{part}": F.array().cast(f"array<{kind}>")
                           for c in words_cols if c not in known
                           for part, kind in (("idx", "int"), ("val", "double"))})
