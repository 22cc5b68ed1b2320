"""SentencePiece encoding and decoding by a weighted transducer (operator 4).

A model file gives a normaliser (a dummy space in front, spaces as the mark
U+2581), a lexicon and byte fallback (the UTF-8 bytes of characters that no
piece has).  They are not kept as states and arcs: the normaliser is a string
replacement, the lexicon a dictionary in which substrings are looked up.  The
lattice of places in a text that their composition would have is searched by
these lookups; the encoding is its shortest path in the tropical semiring (least
sum of weights).  ``load`` refuses models with a normalisation map, with removal
of extra white space or with user-defined or unused pieces.

A unigram model weighs a piece by its negative score.  A byte-pair model is no
sum of scores, so there the pieces weigh nothing and a pair transducer weighs
neighbours: nothing if merging their joint text gives these two pieces, and
infinity if not.  The one path of finite weight is the merge result.

A text is composed in segments: between two characters that stand side by side
in no piece every path has a border, so shortest paths of the segments join.

Edge cases: a null or empty text has no ids and decodes to an empty one; a
literal U+2581 decodes as a space, all other texts come back as they were;
repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trendlens.llm.common import shipped
from trendlens.llm.merge_pairs import MergePairs

SPACE = "▁"
_INFINITE = float("inf")
#: Fixed value: how much worse than the worst piece an unknown character weighs.
_UNKNOWN_PENALTY = 10.0
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _PAIRS = 1, 2


class PieceTransducer:
    """``pieces``: (text, score, kind) by id; ``unigram``: the weighing."""

    def __init__(self, pieces: list[tuple[str, float, int]], unigram: bool,
                 dummy_prefix: bool = True, room: int = 400_000):
        self.unigram, self.dummy_prefix, self._room = unigram, dummy_prefix, room
        self.ids = {p: k for k, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        self._longest = max(map(len, self.ids), default=1)
        scores = {p: s for p, s, kind in pieces if kind == _NORMAL}
        least = min(scores.values(), default=0.0)
        self._weights = {p: -s for p, s in scores.items()} if unigram else dict.fromkeys(scores, 0.0)
        self._unknown_weight = _UNKNOWN_PENALTY - least if unigram else 0.0
        self._unknown = next((k for k, p in enumerate(pieces) if p[2] == _UNKNOWN), 0)
        self._bytes = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        self._sides = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        ranks = {p: -s for p, s in scores.items() if len(p) > 1}
        self._pairs = MergePairs(lambda a, b: ranks.get(a + b), lambda t: len(t) == 1,
                                 room=300_000)
        # Pieces that merging their own text never gives are on no finite path.
        self._good = {p for p in self.ids if unigram or self._pairs.usable(p)}
        self._texts = [bytes([int(p[3:5], 16)]) if kind == _BYTE else b"" if kind == _CONTROL
                       else p.replace(SPACE, " ").encode("utf-8") for p, _, kind in pieces]
        self._words: dict[str, bytes] = {}
        self._segments: dict[str, bytes] = {}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that go on over a space are not supported")

    @classmethod
    def load(cls, path: str) -> PieceTransducer:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kind = model.normalizer_spec, model.trainer_spec.model_type
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or kind not in (
                _UNIGRAM, _PAIRS) or any(p.type in (_USER, _UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: only unigram and byte-pair models with the identity "
                             "normaliser and without user-defined pieces are supported")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], kind == _UNIGRAM,
                   norm.add_dummy_prefix)

    def shortest(self, text: str) -> list[str]:
        """Pieces of the least path through a segment's lattice.  A state is a
        place and, for a byte-pair model, the last piece."""
        return self._least_path(text) if self.unigram else self._finite_path(text)

    def _least_path(self, text: str) -> list[str]:
        best: list[tuple[float, int, str]] = [(0.0, 0, "")]
        for end in range(1, len(text) + 1):
            least = (_INFINITE, 0, "")
            for start in range(max(0, end - self._longest), end):
                piece = text[start:end]
                weight = self._weights.get(
                    piece, self._unknown_weight if end - start == 1 else _INFINITE)
                if best[start][0] + weight < least[0]:
                    least = (best[start][0] + weight, start, piece)
            best.append(least)
        return self._back(best, len(text))

    def _finite_path(self, text: str) -> list[str]:
        """With weights 0 and infinity the first finite path to the end is the
        shortest: depth first, longest arcs first; a state (place, last piece)
        that leads nowhere is not entered again."""
        good, longest, allows, n = self._good, self._longest, self._pairs.allows, len(text)
        pieces: list[str] = []
        starts: list[int] = []
        dead: set[tuple[int, str]] = set()
        at, end = 0, min(n, longest)
        while at < n:
            while end > at:
                piece = text[at:end]
                if (piece in good or end - at == 1) and (
                        not pieces or allows(pieces[-1], piece)) and (
                        not dead or (end, piece) not in dead):
                    pieces.append(piece)
                    starts.append(at)
                    at, end = end, min(n, end + longest)
                    break
                end -= 1
            else:
                dead.add((at, pieces.pop()))
                at, end = starts.pop(), at - 1
        return pieces

    @staticmethod
    def _back(best: list[tuple[float, int, str]], at: int) -> list[str]:
        out = []
        while at:
            _, at, piece = best[at]
            out.append(piece)
        return out[::-1]

    def _output(self, piece: str) -> list[int]:
        k = self.ids.get(piece)
        if k is not None:
            return [k]
        found = [self._bytes.get(b) for b in piece.encode("utf-8")]
        return [self._unknown] if None in found else found

    def _segment(self, text: str) -> bytes:
        got = self._segments.get(text)
        if got is None:
            if len(self._segments) >= self._room:
                self._segments.clear()
            ids = [k for piece in self.shortest(text) for k in self._output(piece)]
            got = self._segments[text] = np.array(ids, "<u4").tobytes()
        return got

    def _word(self, word: str) -> bytes:
        got = self._words.get(word)
        if got is None:
            if len(self._words) >= self._room:
                self._words.clear()
            sides, cuts = self._sides, [0]
            cuts += [k for k in range(1, len(word)) if word[k - 1:k + 1] not in sides]
            cuts.append(len(word))
            got = self._words[word] = b"".join(
                [self._segment(word[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        # The normaliser writes both as U+2581.
        parts = text.replace(SPACE, " ").split(" ")
        head = [] if self.dummy_prefix else [parts.pop(0)]
        if "" in parts:
            words, run = head, ""
            for part in parts:
                run += SPACE + part
                if part:
                    words.append(run)
                    run = ""
            words += [run] * bool(run)
        else:
            words = head + [SPACE + p for p in parts]
        return b"".join([self._word(w) for w in words if w])

    def decode(self, ids: bytes) -> str:
        texts = self._texts
        out = b"".join([texts[k] for k in np.frombuffer(ids, "<u4").tolist()])
        if self.dummy_prefix and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")


_LOADED: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    """One compiled transducer a worker, kept from task to task."""
    if path not in _LOADED:
        _LOADED[path] = PieceTransducer.load(path)
    return _LOADED[path]


def _added(docs: DataFrame, source: str, target: str, kind: T.DataType, fn) -> DataFrame:
    shipped(docs.sparkSession)
    place = docs.columns.index(source)
    schema = T.StructType([*docs.schema.fields, T.StructField(target, kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array(fn(batch.column(place)), arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=schema.names)

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a binary column of ids, little-endian unsigned 32-bit."""
    def fn(column):
        own = transducer(path)
        return [own.encode(t.as_py() or "") for t in column]
    return _added(docs, text, ids, T.BinaryType(), fn)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of a column of ids."""
    def fn(column):
        own = transducer(path)
        return [own.decode(t.as_py() or b"") for t in column]
    return _added(docs, ids, text, T.StringType(), fn)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, round_trip) of every whole text: encoded and
    decoded text by text in one pass, so ids and texts stay in the worker."""
    shipped(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_ids", T.LongType()),
                           T.StructField("ids_crc32", T.LongType()),
                           T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(path)
        for batch in batches:
            n, crc, same = [], [], []
            for t in batch.column(1):
                text = t.as_py() or ""
                ids = own.encode(text)
                n.append(len(ids) // 4)
                crc.append(zlib.crc32(ids))
                same.append(own.decode(ids) == text.replace(SPACE, " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(same, pa.bool_())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
