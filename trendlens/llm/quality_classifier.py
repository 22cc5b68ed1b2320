"""Quality classifier on supervised subword embeddings (operator 10).

Every word, its character n-grams and every pair of neighbouring words have a
learned vector in a hashed table; a window of three words that repeats earlier
words of its text adds one further, shared feature.  A document is the average
of its feature vectors, and a softmax gives its label.  Training is numpy
stochastic gradient descent on at most ``per_label`` documents of each label;
scoring covers every whole text.

With the model fixed, the softmax input is linear in the features, so each
feature is one number when scoring, and a word met before is a table look-up.

Edge cases: a null or empty text has no features and scores what the bias
gives; repeated rows are scored alike; without documents of both labels every
text scores the share of label 1 (0.5 with no labels at all); an empty table
gives an empty result; further columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import labelled_sample, remainder, shipped

_MIX = np.int64(0x9E3779B1)


@dataclass(frozen=True)
class QualityConfig:
    """``per_label``: bound of the training sample.  ``bits``: log2 of the
    hashed table.  ``grams``: lengths of character n-grams."""

    per_label: int = 1000
    bits: int = 17
    dims: int = 8
    epochs: int = 5
    rate: float = 0.5
    grams: tuple = (3,)
    threshold: float = 0.5


@dataclass
class QualityModel:
    """``values``: each feature's part of the difference of the two softmax
    inputs; the last one belongs to repeated windows."""

    values: np.ndarray
    bias: float
    config: QualityConfig


def word_features(word: bytes, config: QualityConfig) -> list[int]:
    """Slots of a word (first) and of its character n-grams."""
    mask, crc = (1 << config.bits) - 1, zlib.crc32
    text = "<" + word.decode("utf-8", "replace") + ">"
    out = [crc(word) & mask]
    for n in config.grams:
        out += [crc(text[k:k + n].encode("utf-8"), n) & mask for k in range(len(text) - n + 1)]
    return out


class _Words(dict):
    """Numbers the words that are met; arrays hold facts of each: its part of
    the softmax input, its count of features and its hash."""

    def __init__(self, model: QualityModel, room: int = 400_000):
        super().__init__()
        self.config, self.values, self.room = model.config, model.values.tolist(), room
        self.part, self.count = np.zeros(1024), np.zeros(1024)
        self.crc = np.zeros(1024, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        if at == len(self.crc):
            self.part, self.count, self.crc = (
                np.append(x, np.zeros_like(x)) for x in (self.part, self.count, self.crc))
        slots = word_features(word, self.config)
        values = self.values
        self.part[at] = sum([values[x] for x in slots])
        self.count[at], self.crc[at] = len(slots), zlib.crc32(word)
        return at

    def trim(self) -> None:
        """Called between texts, so numbers handed out stay valid within one."""
        if len(self) > self.room:
            self.clear()


def _pairs(crc: np.ndarray, bits: int) -> np.ndarray:
    return (crc[:-1] * _MIX + crc[1:]) & np.int64((1 << bits) - 1)


def _repeats(crc: np.ndarray) -> int:
    """How many three-word windows equal an earlier one (by hash)."""
    if len(crc) < 4:
        return 0
    mixed = (crc[:-2] * _MIX + crc[1:-1]) * _MIX + crc[2:]
    return len(mixed) - len(np.unique(mixed))


def _features(text: str, config: QualityConfig):
    """Distinct slots of a text and their shares."""
    tokens = text.encode("utf-8", "replace").split()
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    crc = np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens))
    slots = np.array([x for w in tokens for x in word_features(w, config)], np.int64)
    with np.errstate(over="ignore"):
        slots, again = np.concatenate([slots, _pairs(crc, config.bits)]), _repeats(crc)
    own, counts = np.unique(slots, return_counts=True)
    if again:
        own, counts = np.append(own, 1 << config.bits), np.append(counts, again)
    return own, counts / counts.sum()


def train(sample: list[tuple[int, str]], config: QualityConfig) -> QualityModel:
    size = (1 << config.bits) + 1
    n, good = len(sample), sum(y for y, _ in sample)
    if good in (0, n):
        share = good / n if n else 0.5
        bias = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return QualityModel(np.zeros(size), bias, config)
    bags = [(y, *_features(text, config)) for y, text in sample]
    draw = np.random.default_rng(0)
    table = draw.uniform(-1, 1, (size, config.dims)) / config.dims
    out, bias = np.zeros((2, config.dims)), np.zeros(2)
    seen = np.full(size, 1e-8)
    steps, total = 0, config.epochs * n
    for _ in range(config.epochs):
        for k in draw.permutation(n):
            y, own, part = bags[k]
            rate = config.rate * (1 - steps / total)
            steps += 1
            hidden = part @ table[own]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            back = p @ out
            out -= rate * np.outer(p, hidden)
            bias -= 0.1 * rate * p
            # Adaptive steps: features with little weight in each text still learn.
            seen[own] += part * part
            table[own] -= (rate * part / np.sqrt(seen[own]))[:, None] * back
    return QualityModel(table @ (out[1] - out[0]), float(bias[1] - bias[0]), config)


def fit(docs: DataFrame, labels: DataFrame,
        config: QualityConfig = QualityConfig()) -> QualityModel:
    return train(labelled_sample(docs, labels, "quality", config.per_label), config)


def score_texts(texts, model: QualityModel, words: _Words) -> list[float]:
    values, config, out = model.values, model.config, []
    for text in texts:
        tokens = (text.as_py() or b"").split()
        words.trim()
        z, n = 0.0, 0
        if tokens:
            at = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
            crc = words.crc[at]
            with np.errstate(over="ignore"):
                again, pairs = _repeats(crc), _pairs(crc, config.bits)
            z = words.part[at].sum() + values[pairs].sum() + again * values[-1]
            n = words.count[at].sum() + len(pairs) + again
        out.append(1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z / max(n, 1) + model.bias)))))
    return out


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``."""
    shipped(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    # The table's size is fixed by ``bits``.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        words = _Words(own)
        for batch in batches:
            got = score_texts(batch.column(1).cast(pa.binary()), own, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(got, pa.float64()),
                 pa.array([int(x >= own.config.threshold) for x in got], pa.int32())],
                names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame,
            config: QualityConfig = QualityConfig()) -> DataFrame:
    """Scores of every row of ``docs`` under a model of the labels not held out."""
    out = score(docs, fit(docs, labels, config))
    return out.withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
