"""Binary network on sparse input by synchronous mini-batch Adam (survey M7).

Hidden ReLU layers with dropout, one sigmoid unit, cross-entropy; the weights with
the least loss on validation rows are kept, and training ends ``patience`` epochs
after they were found.  Vectors stay sparse: a block of rows is multiplied with
the first layer's rows of the terms that occur in it, so whole vocabularies are
read.

Rows are dealt once over the rounds of an epoch and written as blocks, a folder a
round.  A round is one pass over its blocks: tasks add up the gradients of theirs,
sums go up a tree, and the driver takes one Adam step.  An epoch has at most
``rounds`` of them, so a batch grows with the data and the number of jobs does not;
the step grows with the root of the batch, as is usual for large batches.  What
moves a round is the weights and one gradient (first-layer rows of terms seen):
features x first layer at most, and the features are bounded by the vocabularies.

Dropout is drawn by (seed, step, block), so a task that runs again gives the same
gradient.  Rows with a null label are not trained on; without training rows the
weights stay as drawn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.operators.array_model import ArrayModel
from trendlens.operators.partitioning import ensure_parallelism
from trendlens.session import scratch_path

#: Rows of a block: it is a dense matrix over the terms that occur in it.
BLOCK_ROWS = 256


def sparse_rows(vector: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries of each row, their indices, their values) of a vector column, whose
    rows may be stored sparse or dense."""
    _, _, indices, values = vector.flatten()
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    whole = np.repeat(indices.is_null().to_numpy(zero_copy_only=False), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at[~whole] = indices.flatten().to_numpy(zero_copy_only=False)
    return lengths, at, flat


def dense_block(lengths, at, values) -> tuple[np.ndarray, np.ndarray]:
    """(features that occur, rows x these)."""
    seen, column = np.unique(at, return_inverse=True)
    x = np.zeros((len(lengths), len(seen)))
    x[np.repeat(np.arange(len(lengths)), lengths), column] = values
    return seen, x


# ---- forward and backward ------------------------------------------------------------

def forward(weights: list, seen: np.ndarray, x: np.ndarray, masks: list | None = None):
    """(activations of each layer, logits); ``weights`` alternate matrix and bias."""
    layers, last = [x], len(weights) // 2 - 1
    for k in range(last + 1):
        w, b = weights[2 * k], weights[2 * k + 1]
        z = layers[-1] @ (w[seen] if k == 0 else w) + b
        if k == last:
            return layers, z[:, 0]
        h = np.maximum(z, 0.0)
        layers.append(h if masks is None else h * masks[k])
    raise ValueError("no layers")


def losses(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z) - y * z


def sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -z))


def gradient(weights: list, seen: np.ndarray, x: np.ndarray, y: np.ndarray,
             masks: list | None = None):
    """(rows, loss, features seen, sums of the gradients): the first matrix's only in
    the rows of the features seen."""
    layers, z = forward(weights, seen, x, masks)
    delta = (sigmoid(z) - y)[:, None]
    out: list = []
    for k in range(len(layers) - 1, -1, -1):
        out = [layers[k].T @ delta, delta.sum(0), *out]
        if k:
            delta = (delta @ weights[2 * k].T) * (layers[k] > 0)
            if masks is not None:
                delta = delta * masks[k - 1]
    return len(y), float(losses(z, y).sum()), seen, out


def added(a, b):
    """The sum of two gradients."""
    seen = np.union1d(a[2], b[2])
    first = np.zeros((len(seen), a[3][0].shape[1]))
    for part in (a, b):
        first[np.searchsorted(seen, part[2])] += part[3][0]
    return (a[0] + b[0], a[1] + b[1], seen,
            [first, *[u + v for u, v in zip(a[3][1:], b[3][1:], strict=True)]])


def dropout_masks(key: tuple, rows: int, hidden: tuple, rate: float) -> list | None:
    if not rate:
        return None
    draw = np.random.default_rng(key)
    return [(draw.random((rows, h)) >= rate) / (1.0 - rate) for h in hidden]


class Adam:
    def __init__(self, weights: list, rate: float, b1: float = 0.9, b2: float = 0.999,
                 eps: float = 1e-7):
        self.rate, self.b1, self.b2, self.eps, self.t = rate, b1, b2, eps, 0
        self.m = [np.zeros_like(w) for w in weights]
        self.v = [np.zeros_like(w) for w in weights]

    def step(self, weights: list, grads: list) -> list:
        self.t += 1
        rate = self.rate * np.sqrt(1 - self.b2 ** self.t) / (1 - self.b1 ** self.t)
        out = []
        for k, (w, g) in enumerate(zip(weights, grads, strict=True)):
            self.m[k] += (1 - self.b1) * (g - self.m[k])
            self.v[k] += (1 - self.b2) * (g * g - self.v[k])
            out.append(w - rate * self.m[k] / (np.sqrt(self.v[k]) + self.eps))
        return out


def drawn(sizes: list[int], seed: int) -> list:
    """Uniform weights within sqrt(6 / (in + out)), no bias."""
    draw, out = np.random.default_rng(seed), []
    for a, b in zip(sizes[:-1], sizes[1:], strict=True):
        limit = np.sqrt(6.0 / (a + b))
        out += [draw.uniform(-limit, limit, (a, b)), np.zeros(b)]
    return out


# ---- blocks ----------------------------------------------------------------------------

_BLOCK = "round int, key long, lengths binary, at binary, vals binary, y binary"


def dealt_blocks(df: DataFrame, rounds: int, seed: int) -> DataFrame:
    """Rows (``v`` vector, ``y`` label) dealt at random over ``rounds``, as blocks."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        draw = np.random.default_rng((seed, part))
        held: list[list] = [[] for _ in range(rounds)]
        n_blocks = 0

        def block(r: int) -> pa.RecordBatch:
            rows, held[r] = held[r], []
            at, values = (np.concatenate([x[k] for x in rows]) for k in (0, 1))
            lengths = np.array([len(x[0]) for x in rows], np.int64)
            y = np.array([x[2] for x in rows])
            cells = [r, part << 32 | n_blocks, lengths.tobytes(), at.astype(np.int64).tobytes(),
                     values.astype(np.float64).tobytes(), y.tobytes()]
            kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=names)

        for batch in batches:
            lengths, at, values = sparse_rows(batch.column(0))
            ends = np.cumsum(lengths)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for k, r in enumerate(draw.integers(0, rounds, batch.num_rows)):
                a, b = ends[k] - lengths[k], ends[k]
                held[r].append((at[a:b], values[a:b], y[k]))
                if len(held[r]) == BLOCK_ROWS:
                    yield block(r)
                    n_blocks += 1
        for r in range(rounds):
            if held[r]:
                yield block(r)
                n_blocks += 1

    return df.mapInArrow(run, _BLOCK)


def _decoded(row):
    lengths, at = np.frombuffer(row["lengths"], np.int64), np.frombuffer(row["at"], np.int64)
    return row["key"], lengths, at, np.frombuffer(row["vals"]), np.frombuffer(row["y"])


def block_sets(df: DataFrame, rounds: int, seed: int) -> list:
    """The blocks of each round, from a written table, held where they are read."""
    spark = df.sparkSession
    path = scratch_path(spark, "network-rows")
    dealt_blocks(ensure_parallelism(df), rounds, seed).write.partitionBy("round").parquet(path)
    table = spark.read.schema(_BLOCK.replace("round int, ", "") + ", round int").parquet(path)
    counts = {r["round"]: r["n"] for r in table.groupBy("round").agg(
        F.sum(F.octet_length("y") / 8).alias("n")).collect()}
    return [table.where(F.col("round") == r).coalesce(max(1, int(n) // (16 * BLOCK_ROWS)))
            .rdd.map(_decoded).persist(StorageLevel.MEMORY_AND_DISK)
            for r, n in sorted(counts.items())]


# ---- the model ---------------------------------------------------------------------------

class NetworkModel(ArrayModel):
    """``w0, b0, w1, ...``: adds ``probability`` (of 0 and 1) and the prediction."""

    @classmethod
    def of(cls, weights: list, features: str) -> NetworkModel:
        return cls({f"{'wb'[k % 2]}{k // 2}": w for k, w in enumerate(weights)}, features)

    @property
    def weights(self) -> list:
        return [self.arrays[f"{c}{k}"] for k in range(len(self.arrays) // 2) for c in "wb"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        features = self.getFeaturesCol()
        at = dataset.columns.index(features)
        shared = dataset.sparkSession.sparkContext.broadcast(self.weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = [np.empty(0)]
                for k in range(0, batch.num_rows, BLOCK_ROWS):
                    rows = batch.slice(k, BLOCK_ROWS).column(at)
                    p.append(sigmoid(forward(shared.value, *dense_block(*sparse_rows(rows)))[1]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(p))],
                                                 names=[*batch.schema.names, "__p"])

        schema = T.StructType([*dataset.schema, T.StructField("__p", T.DoubleType())])
        p = F.col("__p")
        return dataset.mapInArrow(run, schema).withColumns({
            "probability": array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (p > 0.5).cast("double")}).drop("__p")


@dataclass(frozen=True)
class Network:
    """The estimator; ``batch_rows`` is the least batch, ``rate`` the step at it."""

    features: str
    label: str
    hidden: tuple = (64, 32)
    dropout: float = 0.3
    epochs: int = 100
    patience: int = 10
    batch_rows: int = 32
    rounds: int = 20
    rate: float = 1e-3
    seed: int = 42

    def _rows(self, df: DataFrame) -> DataFrame:
        return df.select(F.col(self.features).alias("v"),
                         F.col(self.label).cast("double").alias("y")).where("y IS NOT NULL")

    def fit(self, train: DataFrame, valid: DataFrame, n_features: int) -> NetworkModel:
        train = self._rows(train)
        n = train.count()
        rounds = max(1, min(self.rounds, n // self.batch_rows))
        sets = block_sets(train, rounds, self.seed)
        checks = block_sets(self._rows(valid), 1, self.seed)
        weights = drawn([n_features, *self.hidden, 1], self.seed)
        adam = Adam(weights, self.rate * max(1.0, n / rounds / self.batch_rows) ** 0.5)
        best, best_loss, since = weights, float("inf"), 0
        order = np.random.default_rng(self.seed)
        for _ in range(self.epochs if sets else 0):
            for r in order.permutation(len(sets)):
                rows, _, seen, sums = self._summed(sets[r], weights, adam.t)
                first = np.zeros_like(weights[0])
                first[seen] = sums[0] / rows
                weights = adam.step(weights, [first, *[g / rows for g in sums[1:]]])
            loss = _mean_loss(checks, weights)
            if loss < best_loss:
                best, best_loss, since = weights, loss, 0
            else:
                since += 1
                if since >= self.patience:
                    break
        for blocks in [*sets, *checks]:
            blocks.unpersist()
        return NetworkModel.of(best, self.features)

    def _summed(self, blocks, weights: list, step: int):
        shared = blocks.context.broadcast(weights)
        hidden, rate, seed = self.hidden, self.dropout, self.seed

        def run(part):
            parts = (gradient(shared.value, *dense_block(*block[1:4]), block[4], dropout_masks(
                (seed, step, block[0]), len(block[4]), hidden, rate)) for block in part)
            total = next(parts, None)
            if total is not None:
                yield reduce(added, parts, total)

        out = blocks.mapPartitions(run).treeReduce(added)
        shared.destroy()
        return out


def _mean_loss(checks: list, weights: list) -> float:
    """Mean loss without dropout; 0 without rows."""
    if not checks:
        return 0.0
    shared = checks[0].context.broadcast(weights)

    def run(part):
        out = np.zeros(2)
        for _, lengths, at, values, y in part:
            z = forward(shared.value, *dense_block(lengths, at, values))[1]
            out += losses(z, y).sum(), len(y)
        yield out

    total, n = checks[0].mapPartitions(run).treeReduce(lambda a, b: a + b)
    shared.destroy()
    return float(total / n)
