"""Toxicity by multiple-instance learning (operator 7).

A document is a bag of sentences.  A sentence's score is a logistic function
of its hashed words and word beginnings; the document's is their noisy-or,
1 - prod(1 - sentence score).  Only documents are labelled: the gradient of the
noisy-or tells which sentences must be to blame, and scoring returns those
sentences with their places.

Training takes at most ``per_label`` documents of each label (numpy stochastic
gradient descent on the driver, follow-the-regularised-leader steps with an L1
term, so that words seen in few documents keep weight 0); scoring covers every
whole text.

Edge cases: a null or empty text has no sentence and scores 0; repeated rows
are scored alike; without documents of both labels every text scores 0; an
empty table gives an empty result; further columns play no part.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import labelled_sample, remainder, shipped

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_TOKEN = re.compile(r"\w+")
#: Lengths of the word beginnings that are features beside the words.
_BEGINNINGS = (4, 5)


@dataclass(frozen=True)
class ToxicityConfig:
    """``per_label``: bound of the training sample.  ``bits``: log2 of the
    hashed word table.  ``threshold``: a document is toxic from here on, a
    sentence is returned as offending from ``sentence_threshold`` on."""

    per_label: int = 3000
    bits: int = 18
    epochs: int = 8
    rate: float = 1.0
    sparsity: float = 1.0
    threshold: float = 0.7
    sentence_threshold: float = 0.5


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    config: ToxicityConfig


def _slots(word: str, bits: int) -> list[int]:
    """Slots of a word and of its beginnings, which inflected forms share."""
    raw = [f"{k}:{word[:k]}" if k else word for k in (0, *_BEGINNINGS) if k <= len(word)]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1) for x in raw]


def _bag(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each sentence, and where sentences start."""
    slots, starts = [], []
    for sentence in _SENTENCE.findall(text.lower()):
        own = {x for w in set(_TOKEN.findall(sentence)) for x in _slots(w, bits)}
        if own:
            starts.append(len(slots))
            slots.extend(own)
    return np.array(slots, np.int64), np.array(starts, np.int64)


def train(sample: list[tuple[int, str]], config: ToxicityConfig) -> ToxicityModel:
    bags = [(y, *_bag(text, config.bits)) for y, text in sample]
    bags = [b for b in bags if len(b[1])]
    weights = np.zeros(1 << config.bits)
    if len({y for y, _, _ in bags}) < 2:
        return ToxicityModel(weights, -np.inf, config)
    lead, seen = np.zeros(1 << config.bits), np.zeros(1 << config.bits)
    bias, seen_bias = -5.0, 1.0
    order = np.random.default_rng(0)
    for _ in range(config.epochs):
        for k in order.permutation(len(bags)):
            y, slots, starts = bags[k]
            z = bias + np.add.reduceat(weights[slots], starts)
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
            some = -math.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
            grad = p if y == 0 else -(1.0 - some) / max(some, 1e-9) * p
            each = np.repeat(grad, np.diff(np.append(starts, len(slots))))
            own, inverse = np.unique(slots, return_inverse=True)
            g = np.bincount(inverse, each)
            before = np.sqrt(seen[own])
            seen[own] += g * g
            after = np.sqrt(seen[own])
            lead[own] += g - (after - before) / config.rate * weights[own]
            rest = np.maximum(np.abs(lead[own]) - config.sparsity, 0.0)
            weights[own] = -np.sign(lead[own]) * rest * config.rate / (0.1 + after)
            total = grad.sum()
            seen_bias += total * total
            bias -= 0.1 * config.rate * total / math.sqrt(seen_bias)
    return ToxicityModel(weights.astype(np.float32), float(bias), config)


def fit(docs: DataFrame, labels: DataFrame,
        config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    return train(labelled_sample(docs, labels, "toxic", config.per_label), config)


class _Weights(dict):
    """Weights by word; words met before are not hashed again."""

    def __init__(self, model: ToxicityModel, room: int = 400_000):
        super().__init__()
        self.table, self.bits, self.room = model.weights.tolist(), model.config.bits, room

    def __missing__(self, word: str) -> float:
        if len(self) >= self.room:
            self.clear()
        self[word] = got = sum(self.table[x] for x in _slots(word, self.bits))
        return got


def _sentence_score(z: float) -> float:
    return 1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0


def score_text(text: str, weights: _Weights, bias: float, least: float):
    """(score, number of sentences, offending sentences as (start, end, score))."""
    clean, n, found = 0.0, 0, []
    low = text.lower()
    same_places = len(low) == len(text)
    for m in _SENTENCE.finditer(low if same_places else text):
        part = m.group() if same_places else m.group().lower()
        words = set(_TOKEN.findall(part))
        if not words:
            continue
        n += 1
        p = _sentence_score(bias + sum(map(weights.__getitem__, words)))
        clean += math.log1p(-min(p, 1 - 1e-12))
        if p >= least:
            found.append((m.start(), m.end(), p))
    return -math.expm1(clean), n, found


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted, n_sentences, offending) of every row; places
    are code points of the text."""
    shipped(docs.sparkSession)
    spans = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType())]))
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()), T.StructField("n_sentences", T.LongType()),
        T.StructField("offending", spans)])
    # The word table's size is fixed by ``bits``.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        weights, config = _Weights(own), own.config
        out_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                       ("score", pa.float64())]))
        for batch in batches:
            got = [score_text(t.as_py() or "", weights, own.bias, config.sentence_threshold)
                   for t in batch.column(1)]
            places = [[{"start": a, "end": b, "score": p} for a, b, p in g[2]] for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([int(g[0] >= config.threshold) for g in got], pa.int32()),
                 pa.array([g[1] for g in got], pa.int64()), pa.array(places, out_type)],
                names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame,
             config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """Scores of every row of ``docs`` under a model of the labels not held out."""
    out = score(docs, fit(docs, labels, config))
    return out.withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)


def keep_clean(docs: DataFrame, labels: DataFrame,
               config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns as they were."""
    model = fit(docs, labels, config)
    shipped(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        weights, config = _Weights(own), own.config
        for batch in batches:
            keep = [score_text(t.as_py() or "", weights, own.bias, 2.0)[0] < config.threshold
                    for t in batch.column(place)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
