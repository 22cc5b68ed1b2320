"""Exact token counts of every prefix of a text (operator 6).

For byte-level BPE each prefix of a word has one encoding, found from those of
its shorter prefixes: the last token is the longest one that may follow the
encoding of what stands before it.  So one pass stores the exact count at every
prefix, and how many tokens a prefix has, or how long a prefix fits a budget,
needs no encoding again.

A text is cut before each space that follows something other than white space;
no token reaches over such a place, whatever follows, and pieces met before are
looked up.

Edge cases: a null text is an empty one with no tokens; special strings count
as their one token; repeated rows are counted alike; an empty table gives an
empty result; further columns play no part.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trendlens.llm.common import shipped
from trendlens.llm.merge_pairs import MergePairs

#: Fixed value: how the byte-level pre-tokeniser cuts words.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_CUT = re.compile(r"(?<=\S)(?= )")
_LOOSE = re.compile(r"\s ")


def pieces(text: str) -> list[str]:
    """The text cut before every space that follows a character other than
    white space."""
    if _LOOSE.search(text) or text.startswith(" "):
        return _CUT.split(text) if text else []
    parts = text.split(" ")
    return [parts[0]] * bool(parts[0]) + [" " + p for p in parts[1:]]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself where it
    prints in Latin-1, the next free one from 256 on elsewhere."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PrefixCounts:
    """Counts of one vocabulary file; what was met before is kept in a bounded table."""

    def __init__(self, path: str, room: int = 800_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] \
                or spec["normalizer"] is not None:
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._ranks = {(a, b): k for k, (a, b) in enumerate(merges)}
        made = {a + b: (a, b, k) for (a, b), k in self._ranks.items()}
        self._letters = byte_letters()
        special = [t["content"] for t in spec["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._pattern = regex.compile(PATTERN)
        self._pairs = MergePairs(lambda a, b: self._ranks.get((a, b)), lambda t: len(t) == 1, made)
        self._tokens = {t for t in made if self._pairs.usable(t)} | set(self._letters.values())
        self._longest = max(map(len, self._tokens))
        self._room, self._words, self._counts, self._prefixes = room, {}, {}, {}

    def word(self, word: str) -> bytes | list[int]:
        """Token count at every byte prefix of one pre-token, from 0 bytes on."""
        got = self._words.get(word)
        if got is not None:
            return got
        if len(self._words) >= self._room:
            self._words.clear()
        text = word.encode("utf-8").decode("latin-1").translate(self._letters)
        tokens, longest, allows = self._tokens, self._longest, self._pairs.allows
        last, counts = [""], [0]
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - longest), end):
                token = text[start:end]
                if token in tokens and (not start or allows(last[start], token)):
                    last.append(token)
                    counts.append(counts[start] + 1)
                    break
        self._words[word] = got = bytes(counts) if max(counts) < 256 else counts
        return got

    def _piece(self, piece: str) -> int:
        got = self._counts.get(piece)
        if got is None:
            if len(self._counts) >= self._room:
                self._counts.clear()
            got = self._counts[piece] = sum(
                [self.word(w)[-1] for w in self._pattern.findall(piece)])
        return got

    def _plain(self, text: str) -> Iterator[tuple[int, str, bool]]:
        """(place, run, whether it is a special string) in order."""
        at = 0
        if self._special is not None and "<" in text:
            for m in self._special.finditer(text):
                if m.start() > at:
                    yield at, text[at:m.start()], False
                yield m.start(), m.group(), True
                at = m.end()
        if at < len(text):
            yield at, text[at:], False

    def count(self, text: str) -> int:
        return sum(1 if special else sum(map(self._piece, pieces(run)))
                   for _, run, special in self._plain(text))

    def _in_piece(self, piece: str) -> list[int]:
        """Count of every prefix (in characters) of a piece."""
        got = self._prefixes.get(piece)
        if got is not None:
            return got
        out, before, words = [0], 0, self._pattern.findall(piece)
        at = 0
        for k, word in enumerate(words):
            counts = self.word(word)
            # A cut may fall inside a contraction or join a run of white space;
            # then the few characters since the word before are cut anew.
            tricky = word[0] == "'" or (k and words[k - 1].isspace()) or word.isspace()
            size = 0
            for n in range(1, len(word) + 1):
                size += len(word[n - 1].encode("utf-8"))
                if tricky:
                    back = k - 1 if k and words[k - 1].isspace() else k
                    base = before - (self.word(words[back])[-1] if back < k else 0)
                    start = at - (len(words[back]) if back < k else 0)
                    out.append(base + sum([self.word(w)[-1] for w in
                                           self._pattern.findall(piece[start:at + n])]))
                else:
                    out.append(before + counts[size])
            before += counts[-1]
            at += len(word)
        if len(self._prefixes) >= self._room:
            self._prefixes.clear()
        self._prefixes[piece] = out
        return out

    def prefixes(self, text: str) -> list[int]:
        """Token count of every prefix of a text, from the empty one on."""
        out, base, before = [0], 0, ""
        for _, run, special in self._plain(text):
            if special:
                # Before its last character a special string is ordinary text,
                # which may go on from the piece before.
                rest = base - self._piece(before)
                out += [rest + sum(map(self._piece, pieces(before + run[:n])))
                        for n in range(1, len(run))] + [base + 1]
                base, before = base + 1, ""
                continue
            for before in pieces(run):
                out += [base + n for n in self._in_piece(before)[1:]]
                base += self._piece(before)
        return out

    def fitting(self, text: str, budget: int) -> int:
        """Length of the longest prefix with at most ``budget`` tokens."""
        if self.count(text) <= budget:
            return len(text)
        counts = self.prefixes(text)
        return max(n for n, c in enumerate(counts) if c <= budget)


def token_counts(docs: DataFrame, path: str, limit: int = 512,
                 truncated: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; with
    ``truncated`` also the longest prefix that has at most ``limit`` tokens.
    ``path``: the vocabulary file, present on every executor."""
    shipped(docs.sparkSession)
    fields = [docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    if truncated:
        fields.append(T.StructField("prefix", T.StringType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            n = [counter.count(t) for t in texts]
            out = [batch.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                   pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            if truncated:
                out.append(pa.array([t[:counter.fitting(t, limit)] for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


_COUNTERS: dict[str, PrefixCounts] = {}


def _counter(path: str) -> PrefixCounts:
    """One counter a worker, kept from task to task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounts(path)
    return _COUNTERS[path]
