"""Spelling variants grouped by PartEnum signatures (operator 11).

A word's letter multiset is a binary vector: one dimension for each pair of a
letter and its how-manieth occurrence.  One inserted, deleted or replaced letter
changes one or two dimensions, so near words have vectors of Hamming distance
one or two.  The dimensions are dealt over ``PARTS`` parts; two vectors that
differ in at most two dimensions agree on all parts but some two, so a vector gets
one signature for every choice of two parts to leave out, made from the rest.
Vectors with an equal signature meet, are compared as bit masks, and their words
are then verified letter by letter.  Nothing near is missed.

* Anagrams share one vector and are never near each other, so vectors, not words,
  get signatures; a vector's words travel with it in blocks of ``BLOCK``.
* A pair of vectors shares several signatures; only the one that leaves out the
  least parts verifies it, so that every near pair comes out once.
* One signature of a vector is one of 15, so no bucket holds more than a
  fifteenth of the rows.  A bucket of more than ``BUCKET`` rows is not compared:
  its vectors differ in two parts only, and these are partitioned and enumerated
  again, finer, until every bucket is small.  No pair is given up for that.  A
  level leaves about a third of the dimensions, so ``DEEPEST`` levels leave one or
  two: buckets there hold a few vectors and are compared whatever their rows.

Parts are balanced by how often the dimensions occur (at most ``TABLE`` occurrences
of 90 letters are counted; further ones are dealt by a hash).

Edge cases: a null text has no words; a null id counts as empty text where runs
are altered; repeated rows count as often as they occur; an empty table gives an
empty result; words may be of any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import shipped, text_of, written

#: A run of letters, and the case that is folded.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words have at least so many letters and occurrences, and a
#: form has at least so many times the occurrences of its word.
MIN_LETTERS, MIN_COUNT, FORM_FACTOR = 7, 2, 10
#: Fixed value: one run in so many loses a letter.
ALTERED = 31
PARTS, TABLE, BLOCK, BUCKET, DEEPEST = 6, 6, 256, 1024, 6
_LETTERS = 90
_M = (1 << 64) - 1


def words(docs: DataFrame, min_letters: int = MIN_LETTERS,
          min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of ``docs`` (doc_id, text): the runs of letters, one in 31 of
    them without one letter, that are long and frequent enough."""
    runs = docs.select("doc_id", F.explode(
        F.regexp_extract_all(text_of(), F.lit(RUN), F.lit(0))).alias("run")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.translate("run", UPPER, LOWER).alias("run")).where(F.length("run") >= min_letters)
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % ALTERED == 0, cut).otherwise(F.col("run"))
    counts = runs.select(word.alias("word")).where(F.length("word") >= min_letters)
    return counts.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def letter_number(letter: str) -> int:
    code = ord(letter)
    return code - 97 if code < 128 else 26 + code - 0xC0


def dimensions(word: str) -> list[int]:
    """The dimensions of a word's vector: letter + 90 * (occurrence before)."""
    seen: dict[str, int] = {}
    out = []
    for letter in word:
        k = seen.get(letter, 0)
        seen[letter] = k + 1
        out.append(letter_number(letter) + _LETTERS * k)
    return out


def _mixed(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


class Partition:
    """The part of every dimension, level by level: the first level is given by
    a table, what it lacks and all further levels by a hash."""

    def __init__(self, table: dict[int, int], parts: int = PARTS):
        self.table, self.parts = table, parts
        self._known: dict[tuple[int, int], int] = {}

    def part(self, dimension: int, level: int) -> int:
        if level == 0 and dimension in self.table:
            return self.table[dimension]
        key = (dimension, level)
        if key not in self._known:
            self._known[key] = _mixed(dimension * 0x9E3779B97F4A7C15 + level + 1 & _M) % self.parts
        return self._known[key]

    def signatures(self, dims: list[int], path: str, before: int) -> Iterator[tuple[int, str]]:
        """(signature, path) one level below ``path``; a path has two digits a
        level, the parts left out there."""
        level = len(path) // 2
        for k in range(level):
            out = (int(path[2 * k]), int(path[2 * k + 1]))
            dims = [d for d in dims if self.part(d, k) in out]
        sums = [0] * self.parts
        for d in dims:
            sums[self.part(d, level)] += _mixed(d + 1)
        whole = sum(sums)
        for i, j in combinations(range(self.parts), 2):
            rest = (whole - sums[i] - sums[j]) & _M
            yield _mixed(_mixed(before + i * self.parts + j + 1 & _M) ^ rest), f"{path}{i}{j}"

    def first_path(self, differing: list[int], levels: int) -> str:
        """The path by which a pair with these differing dimensions is verified."""
        path = ""
        for level in range(levels):
            hit = {self.part(d, level) for d in differing}
            i, j = next(c for c in combinations(range(self.parts), 2) if hit <= set(c))
            path += f"{i}{j}"
        return path


def balanced_partition(vocabulary: DataFrame, parts: int = PARTS) -> Partition:
    """Parts of about equal entropy over the vocabulary's vectors.  At most
    ``TABLE`` * 90 counts reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: dict[int, int] = {}
            for word in batch.column(0).to_pylist():
                for d in dimensions(word):
                    if d < TABLE * _LETTERS:
                        count[d] = count.get(d, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.int64()), pa.array(list(count.values()), pa.int64())],
                names=["d", "n"])

    counts = vocabulary.select("word").mapInArrow(run, "d long, n long").groupBy("d").agg(
        F.sum("n").alias("n")).collect()
    total = max((r["n"] for r in counts), default=0) + 1

    def entropy(n: int) -> float:
        p = n / total
        return -p * math.log2(p) - (1 - p) * math.log2(1 - p)

    load, table = [0.0] * parts, {}
    for weight, d in sorted(((entropy(r["n"]), r["d"]) for r in counts), reverse=True):
        k = load.index(min(load))
        table[d] = k
        load[k] += weight
    return Partition(table, parts)


def signed(vocabulary: DataFrame, partition: Partition, block: int = BLOCK) -> DataFrame:
    """(sig, path, words): a row for every signature of every block of words that
    share a vector; ``words`` is "word n word n ...".  Words are dealt by ranges of
    (letters, word), so that a vector of very many words spreads over tasks."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    ranged = vocabulary.select(letters.alias("letters"), "word", "n")
    n = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ranged.repartitionByRange(n, "letters", "word").sortWithinPartitions(
        "letters", "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def rows() -> list[tuple[int, str, str]]:
            if not held:
                return []
            text = " ".join(held)
            return [(sig, path, text) for sig, path in
                    partition.signatures(dimensions(at), "", 0)]

        for batch in batches:
            out = []
            for key, word, count in zip(*[batch.column(k).to_pylist() for k in range(3)],
                                        strict=True):
                if key != at or len(held) >= block:
                    out += rows()
                    at, held = key, []
                held.append(f"{word} {count}")
            yield _signature_rows(out)
        yield _signature_rows(rows())

    return ranged.mapInArrow(run, "sig long, path string, words string")


def _signed_long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _signature_rows(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([_signed_long(r[0]) for r in rows], pa.int64()),
         pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
        names=["sig", "path", "words"])


def _without(word: str, letter: int) -> Iterator[tuple[int, str]]:
    for k, c in enumerate(word):
        if letter_number(c) == letter:
            yield k, word[:k] + word[k + 1:]


def near_words(a: list[str], b: list[str], from_letter: int | None,
               to_letter: int) -> set[tuple[str, str]]:
    """The near pairs of words whose vectors differ by one letter: ``b``'s have
    ``to_letter`` for ``from_letter``, or in addition if that is None."""
    if from_letter is None:
        short = set(a)
        return {(rest, w) for w in b for _, rest in _without(w, to_letter) if rest in short}
    gaps: dict[tuple[int, str], list[str]] = {}
    for w in a:
        for gap in _without(w, from_letter):
            gaps.setdefault(gap, []).append(w)
    return {(v, w) for w in b for gap in _without(w, to_letter) for v in gaps.get(gap, ())}


def _bits(mask: int) -> list[int]:
    out = []
    while mask:
        low = mask & -mask
        out.append(low.bit_length() - 1)
        mask ^= low
    return out


def _bucket_pairs(rows: list[tuple[str, str]], partition: Partition):
    """(word, near, near's n) of one bucket, both ways."""
    by_length: dict[int, list] = {}
    path = rows[0][0]
    for _, text in rows:
        tokens = text.split(" ")
        mask = 0
        for d in dimensions(tokens[0]):
            mask |= 1 << d
        by_length.setdefault(len(tokens[0]), []).append((mask, tokens))
    for length, own in by_length.items():
        longer = by_length.get(length + 1, ())
        for k, (mask, tokens) in enumerate(own):
            for others, allowed in ((own[k + 1:], 2), (longer, 1)):
                for mask_b, tokens_b in others:
                    x = mask ^ mask_b
                    if x.bit_count() != allowed:
                        continue
                    if partition.first_path(_bits(x), len(path) // 2) != path:
                        continue
                    gone, come = _bits(mask & ~mask_b), _bits(mask_b & ~mask)
                    near = near_words(tokens[::2], tokens_b[::2],
                                      gone[0] % _LETTERS if gone else None, come[0] % _LETTERS)
                    for v, w in near:
                        yield v, w, int(tokens_b[2 * tokens_b[::2].index(w) + 1])
                        yield w, v, int(tokens[2 * tokens[::2].index(v) + 1])


def compared(rows: DataFrame, partition: Partition, bucket: int = BUCKET) -> DataFrame:
    """(word, near, near_n) of the near words that meet under a signature; rows
    of buckets that are too large come out again with finer signatures
    (sig, path, words) instead."""
    dealt = rows.repartition("sig", "path").sortWithinPartitions("sig", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, large = None, [], False

        def finer(sig: int, some: list[tuple[str, str]]) -> list[tuple[int, str, str]]:
            return [(s, p, text) for path, text in some for s, p in partition.signatures(
                dimensions(text.split(" ", 1)[0]), path, sig & _M)]

        for batch in batches:
            pairs, again = [], []
            for sig, path, text in zip(*[batch.column(k).to_pylist() for k in range(3)],
                                       strict=True):
                if (sig, path) != at:
                    if len(held) > 1:
                        pairs += _bucket_pairs(held, partition)
                    at, held, large = (sig, path), [], False
                held.append((path, text))
                if large or len(held) > bucket and len(path) < 2 * DEEPEST:
                    again += finer(sig, held)
                    held, large = [], True
            yield _compared_rows(pairs, again)
        if len(held) > 1:
            yield _compared_rows(list(_bucket_pairs(held, partition)), [])

    return dealt.mapInArrow(
        run, "word string, near string, near_n long, sig long, path string, words string")


def _compared_rows(pairs: list, again: list) -> pa.RecordBatch:
    none = [None] * len(pairs)
    lacking = [None] * len(again)
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs] + lacking, pa.string()),
         pa.array([p[1] for p in pairs] + lacking, pa.string()),
         pa.array([p[2] for p in pairs] + lacking, pa.int64()),
         pa.array(none + [_signed_long(r[0]) for r in again], pa.int64()),
         pa.array(none + [r[1] for r in again], pa.string()),
         pa.array(none + [r[2] for r in again], pa.string())],
        names=["word", "near", "near_n", "sig", "path", "words"])


def near_pairs(vocabulary: DataFrame, parts: int = PARTS, bucket: int = BUCKET,
               block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) of every two words of ``vocabulary`` (word, n) that are
    one inserted, deleted or replaced letter apart, both ways round."""
    shipped(vocabulary.sparkSession)
    partition = balanced_partition(vocabulary, parts)
    rows = signed(vocabulary, partition, block)
    found = None
    while True:
        step = written(compared(rows, partition, bucket), "spelling-pairs")
        pairs = step.where(F.col("word").isNotNull()).select("word", "near", "near_n")
        found = pairs if found is None else found.unionByName(pairs)
        rows = step.where(F.col("sig").isNotNull()).select("sig", "path", "words")
        if rows.isEmpty():
            return found


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form), following forms to the last.  A
    form has ten times its word's occurrences, so chains are short; each round
    doubles the steps taken."""
    up = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = up.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        step = written(up.join(further, up["root"] == further["__w"], "left").select(
            "word", F.coalesce("__r", "root").alias("root"),
            F.col("__r").isNotNull().alias("moved")), "spelling-roots")
        up = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return up


def spelling_variants(docs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs``."""
    vocabulary = written(words(docs), "spelling-words")
    near = near_pairs(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    near = near.select(F.col("word").alias("__w"), "n_near", -F.col("best.col1"), "best.near")
    near = near.toDF("__w", "n_near", "best_n", "best")
    joined = vocabulary.join(near, vocabulary["word"] == near["__w"], "left")
    has = F.col("best_n") >= factor * F.col("n")
    out = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
        "spelling-forms")
    last = roots(out.where(F.col("form").isNotNull())).select(
        F.col("word").alias("__w"), F.col("root").alias("__r"))
    return out.join(last, out["word"] == last["__w"], "left").select(
        "word", "form", F.coalesce("__r", "word").alias("root"), "n", "n_near", "form_n")
