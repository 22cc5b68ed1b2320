"""Tokenisation, packing and prefix counts against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from trendlens.llm import packing as P
from trendlens.llm import piece_transducer as X
from trendlens.llm import prefix_tokens as C

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "ab'srelvtm   \n\t.!é漢1️⃣▁<s>0x\x1c\x85 the"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def sentencepiece():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def some_texts(n, size):
    draw = random.Random(4)
    for k in range(n):
        text = "".join(draw.choice(LETTERS) for _ in range(draw.randrange(size)))
        if k % 5 == 0:
            text = text[:9] + "<|endoftext|>" + text[9:]
        if k % 7 == 0:
            text = " " * draw.randrange(20) + text + "=" * draw.randrange(30) + "the  " * 3
        yield text


def test_every_prefix_has_the_library_count(library):
    counter = C.PrefixCounts(BPE)
    for text in some_texts(400, 30):
        want = [len(library.encode(text[:k], add_special_tokens=False).ids)
                for k in range(len(text) + 1)]
        assert counter.prefixes(text) == want
        assert counter.count(text) == want[-1]
        for budget in (0, 3, 9):
            assert counter.fitting(text, budget) == max(
                k for k, c in enumerate(want) if c <= budget)


def test_token_counts(documents, edge, nothing, library):
    for docs in (documents, edge):
        got = C.token_counts(docs, BPE, truncated=True).collect()
        texts = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
        rows = sorted(got, key=lambda r: (str(r.doc_id), r.n_bytes))
        assert len(rows) == len(texts)
        want = sorted((i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids))
                      for i, t in texts)
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
        assert all(len(library.encode(r.prefix).ids) <= 512 for r in rows)
    assert C.token_counts(nothing, BPE).collect() == []


def test_transducer_equals_the_library(sentencepiece):
    own = X.PieceTransducer.load(PIECES)
    for text in some_texts(1500, 40):
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == sentencepiece.encode(text)
        assert own.decode(ids) == text.replace("▁", " ")


def test_unigram_takes_the_shortest_path():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -2.0, 1), ("b", -2.5, 1),
              ("ab", -3.0, 1), ("ba", -1.0, 1), ("▁a", -1.5, 1), ("abb", -9.0, 1)]
    own = X.PieceTransducer(pieces, unigram=True)
    scores = {p: s for p, s, kind in pieces if kind == 1}

    def best(text):
        if not text:
            return 0.0, []
        found = []
        for k in range(1, len(text) + 1):
            if text[:k] in scores or k == 1:
                rest, tail = best(text[k:])
                found.append((rest - scores.get(text[:k], -19.0), [text[:k], *tail]))
        return min(found)

    for text in ("abab", "babba", "aab", "bxa", "abbabab"):
        text = "▁" + text
        cost = sum(-scores.get(p, -19.0) for p in own.shortest(text))
        assert cost == pytest.approx(best(text)[0])
    assert np.frombuffer(own.encode("x"), "<u4").tolist() == [1, 0]


def test_round_trip(documents, edge, nothing, sentencepiece):
    for docs in (documents, edge):
        got = sorted((str(r.doc_id), r.n_ids, r.ids_crc32, r.round_trip)
                     for r in X.round_trip(docs, PIECES).collect())
        want = []
        for r in docs.collect():
            ids = np.array(sentencepiece.encode(r.text or ""), "<u4")
            want.append((str(r.doc_id), len(ids), zlib.crc32(ids.tobytes()), True))
        assert got == sorted(want)
    assert X.round_trip(nothing, PIECES).collect() == []


def test_packing(documents, edge, nothing, library):
    for docs in (documents.repartition(3), edge.repartition(2)):
        packed = P.pack(docs, BPE, window=256, with_ids=True).cache()
        rows = packed.collect()
        at = 0
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.sequence_id * 256 + r.offset == at and r.offset + r.length <= 256
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
            at += r.length
        want = sorted(zlib.crc32(np.array([*library.encode(
            t.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
            for t in docs.collect())
        whole, ids, doc = [], b"", None
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.start == len(ids) // 4 and (doc is None or doc == r.doc_id or not ids)
            ids, doc = ids + bytes(r.ids), r.doc_id
            if len(ids) == 4 * r.doc_tokens:
                whole.append(zlib.crc32(ids))
                ids = b""
        assert sorted(whole) == want and not ids
        sequences = P.sequences(packed, 256).collect()
        assert len(sequences) == -(-at // 256)
        last = at % 256 or 256
        padded = last if last & (last - 1) == 0 else 256
        assert sorted(len(r.ids) // 4 for r in sequences) == sorted(
            [256] * (len(sequences) - 1) + [padded])
        packed.unpersist()
    assert P.pack(nothing, BPE).collect() == []
    assert P.sequences(P.pack(nothing, BPE, with_ids=True)).agg(F.count("*")).first()[0] == 0


def test_encoder_equals_the_library(library):
    encoder = P.Encoder(BPE)
    texts = list(some_texts(600, 50))
    texts += ["".join(c for c in t if c < "ɐ") for t in texts] + ["", "ßÿŁ²ªº¼ I'm\xa0x"]
    for text, ids in zip(texts, encoder.batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids
