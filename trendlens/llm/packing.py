"""Concatenate-and-cut packing of documents into fixed windows (operator 5).

Pass 1 tokenises each document, ends it with a separator id and writes its ids
with its place inside its partition.  A prefix sum over the partitions' totals
turns these into places in one endless row of ids.  Pass 2 cuts that row every
``window`` ids: a document becomes one piece for each window it touches, and
only the last window is not full.  ``sequences`` puts windows together; those
that lie inside one partition need no exchange, only the fragments at its
borders meet by their sequence id.

Edge cases: a null or empty text is a lone separator; repeated rows are packed
each on its own; an empty table gives an empty result; further columns play no
part.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import shipped, written
from trendlens.llm.prefix_tokens import PATTERN, byte_letters, pieces

WINDOW = 1024
_MARKS = frozenset(".,;:!?")


#: Characters whose classes are the same in every Unicode version in use.
_OTHER = re.compile("[^\x00-\u024f]")


class Encoder:
    """Ids of texts as the tokenizers library gives them for a vocabulary file.

    Texts of common letters go through tiktoken on the same vocabulary, which
    gives the same ids several times faster.  All others go through the library
    itself; pieces of text met before are looked up in a bounded table.  No
    token reaches over the border of two pieces."""

    def __init__(self, path: str, room: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._room = Tokenizer.from_file(path), room
        self._fast = same_ranks(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self._kept: dict[str, bytes] = {}

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out = []
        for at in range(0, len(texts), 500):
            part = texts[at:at + 500]
            own = [k for k, t in enumerate(part) if self._fast is None or _OTHER.search(t)
                   or self._special.search(t)]
            if not own:
                out += map(_raw, [self._fast.encode_ordinary(t) for t in part])
                continue
            rest = sorted(set(range(len(part))).difference(own))
            got = dict(zip(own, self._by_pieces([part[k] for k in own]), strict=True))
            if rest:
                ids = [self._fast.encode_ordinary(part[k]) for k in rest]
                got.update(zip(rest, map(_raw, ids), strict=True))
            out += [got[k] for k in range(len(part))]
        return out

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 500):
            cut = list(map(self._cut, texts[at:at + 500]))
            if len(self._kept) >= self._room:
                self._kept.clear()
            self._learn(set(chain.from_iterable(cut)).difference(self._kept))
            known = self._kept.__getitem__
            out += [b"".join(map(known, parts)) for parts in cut]
        return out

    def _learn(self, new: set[str]) -> None:
        kept = self._kept
        # A mark after a letter is a word of its own, so most pieces that end
        # in one are known but for the mark.
        marked = [p for p in new if p[-1] in _MARKS and len(p) > 2 and p[-2].isalpha()]
        plain = [p for p in new.difference(marked).union(
            [p[:-1] for p in marked], [p[-1] for p in marked]) if p not in kept]
        got = self._tokenizer.encode_batch_fast(plain, add_special_tokens=False)
        kept.update(zip(plain, (_raw(e.ids) for e in got), strict=True))
        for p in marked:
            kept[p] = kept[p[:-1]] + kept[p[-1]]

    def _cut(self, text: str) -> list[str]:
        if "<" not in text or not self._special.search(text):
            return pieces(text)
        # Every second part is a special string, which is one token anywhere.
        out = []
        for k, part in enumerate(self._special.split(text)):
            out += [part] if k % 2 else pieces(part)
        return out


def same_ranks(path: str):
    """A tiktoken encoding of the file's vocabulary; None where its ids are not
    in the order of its merges, so that ids can't serve as ranks."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] \
            or spec["normalizer"] is not None:
        return None
    vocabulary, byte = model["vocab"], {c: b for b, c in byte_letters().items()}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [*sorted(vocabulary[c] for c in byte), *[vocabulary[t] for t in merged]]
    if order != sorted(set(order)) or len(order) != len(vocabulary):
        return None
    ranks = {bytes(byte[c] for c in t): k for t, k in vocabulary.items()}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def _raw(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenised(docs: DataFrame, path: str, separator: int = 0) -> DataFrame:
    """Pass 1: (part, doc_id, first, n, ids); ``first`` is the document's place
    among its partition's ids, which are kept as 32-bit numbers."""
    shipped(docs.sparkSession)
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), docs.schema["doc_id"],
        T.StructField("first", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("ids", T.BinaryType())])
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, at = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [x + end for x in own.batch([t.as_py() or "" for t in batch.column(1)])]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            first = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int32()), batch.column(0), pa.array(first),
                 pa.array(n), pa.array(ids, pa.binary())], names=schema.names)

    return written(docs.select("doc_id", "text").mapInArrow(run, schema), "token-ids")


def placed(tokens: DataFrame) -> DataFrame:
    """Adds ``place``: where a document starts among all ids."""
    totals = tokens.groupBy("part").agg(F.max(F.col("first") + F.col("n")).alias("__n"))
    # One row a partition of pass 1: the window and the broadcast hold no more.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("__part"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    joined = tokens.join(F.broadcast(totals), F.col("part") == F.col("__part"))
    return joined.withColumn("place", F.col("__base") + F.col("first")).drop("__part", "__base")


def pack(docs: DataFrame, path: str, window: int = WINDOW, separator: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pass 2: one row for each piece of a document: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset; with ``with_ids`` its ids."""
    rows = placed(tokenised(docs, path, separator)).select("doc_id", "place", "ids")
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    fields = [docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in names]]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out, raw = [], [], []
            for k, (place, ids) in enumerate(zip(batch.column(1).to_pylist(),
                                                 batch.column(2).to_pylist(), strict=True)):
                n, at = len(ids) // 4, 0
                while at < n:
                    sequence, offset = divmod(place + at, window)
                    length = min(n - at, window - offset)
                    piece = ids[4 * at:4 * (at + length)]
                    row.append(k)
                    out.append((at, length, zlib.crc32(piece), n, sequence, offset))
                    if with_ids:
                        raw.append(piece)
                    at += length
            columns = zip(*out, strict=True) if out else [()] * len(names)
            arrays = [batch.column(0).take(pa.array(row, pa.int64())),
                      *[pa.array(c, pa.int64()) for c in columns]]
            if with_ids:
                arrays.append(pa.array(raw, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, length) of pieces packed with their ids.  A piece that
    fills a window is one already; the others meet by sequence id, at most
    ``window`` pieces of at least one id each.  ``ids`` is padded to ``window``
    unless ``length`` is a power of two."""
    full = packed.where(F.col("length") == window).select("sequence_id", "ids", "length")
    rest = packed.where(F.col("length") < window).groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("__p"),
        F.sum("length").alias("length"))
    joined = F.aggregate("__p", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    rest = rest.select("sequence_id", joined.alias("ids"), "length")
    power = F.bit_count("length") == 1
    fill = F.unhex(F.repeat(F.lit(np.array([pad], "<u4").tobytes().hex()),
                            (F.lit(window) - F.col("length")).cast("int")))
    both = full.unionByName(rest)
    return both.withColumn("ids", F.when(power, F.col("ids")).otherwise(
        F.concat("ids", fill)))
