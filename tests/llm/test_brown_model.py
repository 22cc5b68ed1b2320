"""Counts and base scores against a plain count; the model against itself."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from trendlens.llm import brown_model as B

SMALL = B.BrownConfig(lexicon=400, units=64, groups=32, classes=8, sweeps=3)


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update((text or "").encode().lower().split())
            counts[b""] += 1
    return counts


def check(out, rows):
    counts = plain(rows)
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for doc_id, text in rows:
        words = [*(text or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        want.append((str(doc_id), len(words), sum(counts[w] > 0 for w in words), total,
                     round(base, 5)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5))
           for r in out]
    assert sorted(got) == sorted(want)


def test_counts_and_base_score(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    config = B.BrownConfig(lexicon=3000, units=1024, groups=256, classes=32, sweeps=6)
    out = B.class_scores(documents, config).collect()
    check(out, rows)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge_rows(edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    out = B.class_scores(edge, SMALL).collect()
    check(out, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert B.class_scores(nothing, SMALL).collect() == []


def test_model_is_a_distribution(documents):
    model, counts = B.train(documents.select("doc_id", "text"), SMALL)
    assert np.allclose((10 ** model.step).sum(1), 1.0)
    by_class = Counter()
    kinds = Counter()
    for r in counts.collect():
        word = bytes(r["word"])
        unit = 0 if not word else int(model.lexicon.units_of(
            [word], model.lexicon.places([word]))[0])
        by_class[int(model.classes[unit])] += r["n"] + 0.5
        kinds[int(model.classes[unit])] += 1
    for c, mass in by_class.items():
        # The rest is the share of unseen words.
        assert (mass + 0.5) / 10 ** model.mass[c] == pytest.approx(1.0)


def test_exchange_raises_the_likelihood():
    draw = np.random.default_rng(3)
    # Words of two kinds that take turns.
    text = np.ravel(np.column_stack([draw.integers(1, 6, 4000), draw.integers(6, 11, 4000)]))
    n, k = 11, 3
    classes = np.array([0] + [1 + u % 2 for u in range(1, n)])
    first = None
    for turn in range(6):
        right, left, own = np.zeros((n, k), int), np.zeros((n, k), int), np.zeros(n, int)
        np.add.at(right, (text[:-1], classes[text[1:]]), 1)
        np.add.at(left, (text[1:], classes[text[:-1]]), 1)
        np.add.at(own, text[:-1][text[:-1] == text[1:]], 1)
        value = B.likelihood(B.class_pairs(right, classes, k))
        first = value if first is None else first
        classes = B.exchange(right, left, own, classes, k, turn)
    assert value > first
    assert len(set(classes[1:6])) == len(set(classes[6:])) == 1 and classes[1] != classes[6]
