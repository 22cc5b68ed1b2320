"""Scores by a Brown class-based bigram model (operator 1).

P(word | word before) = P(class | class before) * P(word | class).  Classes
come from exchange clustering: sweep after sweep, words move to the class
where the likelihood of the training text's class bigrams is highest.  The
``units`` - 1 most frequent words move one by one; all other words, unseen ones
too, move in ``groups`` buckets by a hash of their last bytes, which unrelated
endings share, so every word has a class and the clustering's size is fixed.

Every count covers all training texts: word counts are added up in Spark, each
sweep reads all class contexts again, and the emission counts of words outside
the bounded ``lexicon`` are joined, not broadcast.  What reaches the driver is
fixed by the parameters: the lexicon (at most ``lexicon`` words) and the
units-by-classes context counts.

Edge cases: a null or empty text is its end alone; rows that repeat are counted
and scored one by one; a row without id is training text; without training
texts every token has the same chance; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import remainder, shipped, written

#: The text's end, counted as a token; no word is empty.
END = b""
_FLUSH = 300_000


@dataclass(frozen=True)
class BrownConfig:
    lexicon: int = 1 << 18
    units: int = 4096
    groups: int = 1024
    classes: int = 64
    sweeps: int = 6
    add: float = 0.5
    prior: float = 50.0
    suffix: int = 4

    @property
    def all_units(self) -> int:
        return self.units + self.groups


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all words of ``text``, and the ends under the empty word."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()),
                                           pa.array(counts.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                counts.update((text.as_py() or b"").lower().split())
            counts[END] += batch.num_rows
            if len(counts) > _FLUSH:
                yield batch_of(counts)
                counts = Counter()
        yield batch_of(counts)

    parts = texts.select("text").mapInArrow(run, schema)
    return written(parts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "brown-words")


class Lexicon:
    """The frequent words with their counts, and the unit of every word."""

    def __init__(self, words: list[bytes], counts: np.ndarray, config: BrownConfig):
        self.words, self.counts, self.config = words, counts, config
        self.units = np.array([k + 1 if k + 1 < config.units else self.group(w)
                               for k, w in enumerate(words)], np.int64)
        self._places: dict | None = None

    def group(self, word: bytes) -> int:
        c = self.config
        return c.units + zlib.crc32(word[-c.suffix:]) % c.groups

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the lexicon, -1 for the others."""
        if self._places is None:
            self._places = {w: k for k, w in enumerate(self.words)}
        return np.array(list(map(self._places.get, words, repeat(-1))), np.int64)

    def units_of(self, words: list[bytes], places: np.ndarray) -> np.ndarray:
        out = self.units[places] if len(self.units) else np.zeros(len(words), np.int64)
        for k in np.flatnonzero(places < 0).tolist():
            out[k] = self.group(words[k])
        return out

    def __getstate__(self):
        return self.__dict__ | {"_places": None}


def lexicon(counts: DataFrame, config: BrownConfig) -> Lexicon:
    """The words from some count on, at most ``lexicon`` of them.  The limit
    comes from a histogram of counts on a logarithmic scale."""
    level = F.floor(F.log2("n") * 16).cast("int")
    words = counts.where(F.octet_length("word") > 0).withColumn("level", level)
    histogram = words.groupBy("level").count().collect()
    least, room = None, config.lexicon
    for row in sorted(histogram, key=lambda r: -r["level"]):
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    found = [] if least is None else words.where(F.col("level") >= least).select(
        "word", "n").collect()
    found.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    return Lexicon([bytes(r["word"]) for r in found],
                   np.array([r["n"] for r in found], np.int64), config)


def unit_rows(texts: DataFrame, shared) -> DataFrame:
    """Each training text as its units between two ends, 16 bits each."""
    schema = T.StructType([T.StructField("units", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(0).cast(pa.binary()):
                words = (text.as_py() or b"").lower().split()
                units = own.units_of(words, own.places(words))
                rows.append(np.concatenate([[0], units, [0]]).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["units"])

    return written(texts.select("text").mapInArrow(run, schema), "brown-units")


def contexts(rows: DataFrame, classes: np.ndarray, config: BrownConfig):
    """Over all training texts: how often each class follows and precedes each
    unit (units x classes each), and how often a unit follows itself.

    A task adds up its texts in fixed arrays and hands on what isn't zero in
    blocks of units; the blocks' parts are streamed in order and added up."""
    n, k, block = config.all_units, config.classes, 64
    width = 2 * k + 1
    shared = rows.sparkSession.sparkContext.broadcast(classes)
    schema = T.StructType([T.StructField("block", T.IntegerType()),
                           T.StructField("at", T.BinaryType()), T.StructField("n", T.BinaryType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        right, left = np.zeros(n * k, np.int64), np.zeros(n * k, np.int64)
        own = np.zeros(n, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                texts = batch.column(0)[start:start + 1000].to_pylist()
                units = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
                # The end of a text and the beginning of the next are no pair.
                inside = np.ones(len(units) - 1, bool)
                inside[np.cumsum([len(x) // 2 for x in texts])[:-1] - 1] = False
                a, b = units[:-1][inside], units[1:][inside]
                right += np.bincount(a * k + of[b], minlength=n * k)
                left += np.bincount(b * k + of[a], minlength=n * k)
                own += np.bincount(a[a == b], minlength=n)
        table = np.concatenate([right.reshape(n, k), left.reshape(n, k), own[:, None]], axis=1)
        out = []
        for first in range(0, n, block):
            part = table[first:first + block].ravel()
            at = np.flatnonzero(part)
            if len(at):
                out.append((first, at.astype("<i4").tobytes(), part[at].astype("<i8").tobytes()))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()),
             pa.array(columns[2], pa.binary())], names=schema.names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, at, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if first not in sums:
                    sums[first] = np.zeros(block * width, np.int64)
                sums[first][np.frombuffer(at, "<i4")] += np.frombuffer(part, "<i8")
        every = np.arange(block * width, dtype="<i4").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.int32()), pa.array([every] * len(sums), pa.binary()),
             pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())],
            names=schema.names)

    sums = rows.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema)
    table = np.zeros((n + block, width), np.int64)
    for row in sums.collect():
        table[row["block"]:row["block"] + block] = np.frombuffer(row["n"], "<i8").reshape(-1, width)
    table = table[:n]
    return table[:, :k], table[:, k:2 * k], table[:, -1]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to a constant."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum())


def class_pairs(right: np.ndarray, classes: np.ndarray, k: int) -> np.ndarray:
    pairs = np.zeros((k, k))
    np.add.at(pairs, classes, right)
    return pairs


def exchange(right, left, own, classes: np.ndarray, k: int, turn: int = 0,
             fixed: int = 1) -> np.ndarray:
    """One sweep: in turn, units move to their best class.  The table of class
    bigrams follows each move; a unit's contexts are those at the sweep's start,
    so only every second unit moves, the others in the next ``turn``.  The first
    ``fixed`` units (the end) stay in classes of their own."""
    classes = classes.copy()
    pairs = class_pairs(right, classes, k)
    for u in np.argsort(-right.sum(1), kind="stable"):
        if u < fixed or (turn + u) % 2 or not right[u].any():
            continue
        a, s = classes[u], float(own[u])
        r, c = right[u].astype(float), left[u].astype(float)
        r[a] -= s
        c[a] -= s
        pairs[a] -= r
        pairs[:, a] -= c
        pairs[a, a] -= s
        np.maximum(pairs, 0.0, out=pairs)
        # Wherever the unit goes, its neighbours' classes get their counts back.
        rows, columns = pairs.sum(1) + c, pairs.sum(0) + r
        gain = (_xlogx(pairs + r).sum(1) - _xlogx(pairs).sum(1)
                + _xlogx(pairs + c[:, None]).sum(0) - _xlogx(pairs).sum(0))
        d = np.diagonal(pairs)
        gain += _xlogx(d + r + c + s) - _xlogx(d + r) - _xlogx(d + c) + _xlogx(d)
        gain -= _xlogx(rows + r.sum() + s) - _xlogx(rows)
        gain -= _xlogx(columns + c.sum() + s) - _xlogx(columns)
        gain[:fixed] = -np.inf
        b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-9 else a
        pairs[b] += r
        pairs[:, b] += c
        pairs[b, b] += s
        classes[u] = b
    return classes


@dataclass
class BrownModel:
    """``step``: log10 P(class | class before); ``mass``: log10 of a class's
    emission denominator; ``total``: log10 of the base denominator."""

    lexicon: Lexicon
    classes: np.ndarray
    step: np.ndarray
    mass: np.ndarray
    total: float
    tokens: int
    ends: int
    sweeps: list[float]


def train(texts: DataFrame, config: BrownConfig = BrownConfig()) -> tuple[BrownModel, DataFrame]:
    """The model of all ``text`` rows, and the table of all word counts."""
    shipped(texts.sparkSession)
    sc = texts.sparkSession.sparkContext
    counts = word_counts(texts)
    total = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(
        F.octet_length("word") == 0, F.col("n")))).first()
    tokens, distinct, ends = int(total[0] or 0), int(total[1]), int(total[2] or 0)
    lex = lexicon(counts, config)
    shared = sc.broadcast(lex)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = np.zeros(config.all_units, np.int64)
        for batch in batches:
            words = batch.column(0).to_pylist()
            units = own.units_of(words, own.places(words))
            sums += np.bincount(units, minlength=config.all_units)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at])],
                                         names=["unit", "n"])

    rows = unit_rows(texts, shared)
    kinds = np.zeros(config.all_units)
    kinds[0] = bool(ends)
    found = counts.where(F.octet_length("word") > 0).select("word").mapInArrow(
        spread, "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n")).collect()
    for row in found:
        kinds[row["unit"]] += row["n"]

    k = config.classes
    # Class 0 is the end's own; the others start dealt out by unit.
    classes = np.where(np.arange(config.all_units) == 0, 0,
                       1 + np.arange(config.all_units) % (k - 1))
    best, sweeps = None, []
    for sweep in range(config.sweeps + 1):
        right, left, own = contexts(rows, classes, config)
        pairs = class_pairs(right, classes, k)
        sweeps.append(likelihood(pairs))
        if best is None or sweeps[-1] > best[0]:
            best = (sweeps[-1], classes, pairs)
        if sweep < config.sweeps:
            classes = exchange(right, left, own, classes, k, sweep)
    _, classes, pairs = best
    held = pairs.sum(0)
    share = (held + 1.0) / (held.sum() + k)
    step = np.log10((pairs + config.prior * share) / (pairs.sum(1, keepdims=True) + config.prior))
    words = np.bincount(classes, kinds, minlength=k)
    mass = np.log10(held + config.add * (words + 1))
    model = BrownModel(lex, classes, step, mass, float(np.log10(
        tokens + config.add * (distinct + 1))), tokens, ends, sweeps)
    return model, counts


def score(docs: DataFrame, model: BrownModel, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) of every row."""
    shipped(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()),
                                     T.StructField("times", T.LongType())]))
    schema = T.StructType([
        T.StructField("row", T.LongType()), docs.schema["doc_id"],
        T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("classed", T.DoubleType()),
        T.StructField("rest", rest)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = shared.value, TaskContext.get().partitionId() << 33
        lex, step, mass, classes = own.lexicon, own.step, own.mass, own.classes
        seen = np.log10(lex.counts + 0.5)
        end = float(np.log10(own.ends + 0.5))
        for batch in batches:
            out, tails = [], []
            for text in batch.column(1).cast(pa.binary()):
                words = (text.as_py() or b"").lower().split()
                places = lex.places(words)
                inside = places[places >= 0]
                c = np.concatenate([[0], classes[lex.units_of(words, places)], [0]])
                emitted = end + float(seen[inside].sum())
                n = len(words) + 1
                out.append((n, len(inside) + (own.ends > 0), emitted - n * own.total,
                            emitted + float(step[c[:-1], c[1:]].sum()) - float(mass[c[1:]].sum())))
                tail = Counter([words[k] for k in np.flatnonzero(places < 0).tolist()])
                tails.append([{"word": w, "times": m} for w, m in tail.items()])
            ids = np.arange(row, row + len(out))
            row += len(out)
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column(0),
                 *[pa.array(x, kind) for x, kind in zip(columns, (
                     pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)],
                 pa.array(tails, pa.list_(pa.struct([("word", pa.binary()),
                                                     ("times", pa.int64())])))],
                names=schema.names)

    parts = written(docs.select("doc_id", "text").mapInArrow(run, schema), "brown-parts")
    # Words outside the lexicon meet their counts by a shuffle; frequent words,
    # which would be its hot keys, are all in the lexicon.
    rare = parts.select("row", F.inline("rest"))
    rare = rare.join(counts, "word", "left").select(
        "row", (F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("times"))
    rare = rare.groupBy(F.col("row").alias("__row")).agg(
        F.sum("log").alias("__log"), F.sum("times").alias("__known"))
    both = parts.drop("rest").join(rare, F.col("row") == F.col("__row"), "left")
    log = F.coalesce("__log", F.lit(0.0))
    return both.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        (F.col("base") + log).alias("base_score"), (F.col("classed") + log).alias("score"),
        F.pow(F.lit(10.0), -(F.col("classed") + log) / F.col("n_tokens")).alias("perplexity"))


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 5) == 1


def class_scores(docs: DataFrame, config: BrownConfig = BrownConfig()) -> DataFrame:
    """Scores of all whole texts by a model of those not held out."""
    docs = docs.select("doc_id", "text")
    model, counts = train(docs.where(~held_out(F.col("doc_id"))), config)
    out = score(docs, model, counts)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
                      "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                      "base_score", "score", "perplexity")
