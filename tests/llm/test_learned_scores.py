"""Toxicity and quality scores of small models recomputed plainly, and training
steps against finite differences of the objective."""

import math
import re
import zlib

import numpy as np

from trendlens.llm import quality_classifier as K
from trendlens.llm import toxicity as X

TEXTS = ["A bad zorg. fine day!\nbad bad", "", None, "one fine day", "Zorgs are bad? zorg, ZORG.",
         "…!", "fine fine fine fine fine fine day day", "tö 世界 zorg. é́"]


def slots(word, bits):
    keys = [word] + [f"{n}:{word[:n]}" for n in (4, 5) if len(word) >= n]
    return [zlib.crc32(k.encode()) % 2 ** bits for k in keys]


def sentences(text, bits):
    found = [re.findall(r"\w+", s) for s in re.findall(r"[^.!?\n]+[.!?]*", text.lower())]
    return [sorted(set(words)) for words in found if words]


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def test_toxicity_is_the_noisy_or_of_its_sentences(spark):
    config = X.ToxicityConfig(bits=6, threshold=0.6)
    weights = np.random.default_rng(1).normal(size=64)
    model = X.ToxicityModel(weights, -1.0, config)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in X.score(docs, model).collect():
        clean, n, offending = 1.0, 0, 0
        for words in sentences(TEXTS[r.doc_id] or "", 6):
            p = sigmoid(-1.0 + sum(weights[s] for w in words for s in slots(w, 6)))
            clean, n, offending = clean * (1 - p), n + 1, offending + (p >= 0.5)
        assert abs(r.score - (1 - clean)) < 1e-12
        assert (r.n_sentences, len(r.offending)) == (n, offending)
        assert r.predicted == int(r.score >= 0.6)


def test_toxicity_steps_follow_the_gradient():
    config = X.ToxicityConfig(bits=5, epochs=2, sparsity=0.05, rate=0.5)
    sample = [(1, "a bad zorg. fine day"), (0, "one fine day. bad luck"), (1, "zorg"), (0, "day")]

    def loss(weights, bias, y, text):
        logs = []
        for words in sentences(text, 5):
            own = {s for w in words for s in slots(w, 5)}
            logs.append(math.log1p(-sigmoid(bias + sum(weights[s] for s in own))))
        return -sum(logs) if y == 0 else -math.log(-math.expm1(sum(logs)))

    weights, lead, seen = np.zeros(32), np.zeros(32), np.zeros(32)
    bias, seen_bias, h = -5.0, 1.0, 1e-5
    draw = np.random.default_rng(0)
    for _ in range(2):
        for k in draw.permutation(4):
            y, text = sample[k]
            touched = {s for words in sentences(text, 5) for w in words for s in slots(w, 5)}
            grad = np.zeros(32)
            for s in touched:
                up, down = weights.copy(), weights.copy()
                up[s] += h
                down[s] -= h
                grad[s] = (loss(up, bias, y, text) - loss(down, bias, y, text)) / (2 * h)
            g_bias = (loss(weights, bias + h, y, text) - loss(weights, bias - h, y, text)) / (2 * h)
            for s in touched:
                before = math.sqrt(seen[s])
                seen[s] += grad[s] ** 2
                lead[s] += grad[s] - (math.sqrt(seen[s]) - before) / 0.5 * weights[s]
                rest = max(abs(lead[s]) - 0.05, 0.0)
                weights[s] = -math.copysign(rest, lead[s]) * 0.5 / (0.1 + math.sqrt(seen[s]))
            seen_bias += g_bias ** 2
            bias -= 0.05 * g_bias / math.sqrt(seen_bias)
    got = X.train(sample, config)
    assert np.abs(weights).max() > 0.05
    assert np.allclose(got.weights, weights, atol=1e-4) and abs(got.bias - bias) < 1e-5


def grams(text, config):
    """Slots of a text's features, the last slot for repeated windows."""
    words = text.encode().split()
    size = 2 ** config.bits
    out = []
    for w in words:
        out.append(zlib.crc32(w) % size)
        marked = f"<{w.decode()}>"
        for n in config.grams:
            out += [zlib.crc32(marked[k:k + n].encode(), n) % size
                    for k in range(len(marked) - n + 1)]
    for a, b in zip(words, words[1:], strict=False):
        out.append((zlib.crc32(a) * 0x9E3779B1 + zlib.crc32(b)) % 2 ** 64 % size)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    return out + [size] * (len(windows) - len(set(windows)))


def test_quality_is_the_mean_of_its_features(spark):
    config = K.QualityConfig(bits=7, grams=(2, 3))
    values = np.random.default_rng(2).normal(size=129)
    model = K.QualityModel(values, 0.3, config)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in K.score(docs, model).collect():
        own = grams(TEXTS[r.doc_id] or "", config)
        mean = sum(values[s] for s in own) / len(own) if own else 0.0
        assert abs(r.score - sigmoid(mean + 0.3)) < 1e-12
        assert r.predicted == int(r.score >= 0.5)


def test_quality_steps_follow_the_gradient():
    config = K.QualityConfig(bits=4, dims=2, epochs=2, rate=0.3)
    sample = [(1, "fine day fine day fine day"), (0, "bad zorg"), (0, "bad bad bad bad"), (1, "day")]
    draw = np.random.default_rng(0)
    table = draw.uniform(-1, 1, (17, 2)) / 2
    out, bias, seen, h, step = np.zeros((2, 2)), np.zeros(2), np.full(17, 1e-8), 1e-6, 0

    def loss(table, out, bias, y, text):
        own = grams(text, config)
        hidden = sum(table[s] for s in own) / len(own)
        z = out @ hidden + bias
        return math.log(sum(math.exp(v) for v in z)) - z[y]

    def slope(at, y, text):
        params = [table, out, bias]
        grad = np.zeros_like(params[at])
        for place in np.ndindex(grad.shape):
            side = []
            for sign in (h, -h):
                moved = [p.copy() for p in params]
                moved[at][place] += sign
                side.append(loss(*moved, y, text))
            grad[place] = (side[0] - side[1]) / (2 * h)
        return grad

    for _ in range(2):
        for k in draw.permutation(4):
            y, text = sample[k]
            rate = 0.3 * (1 - step / 8)
            step += 1
            g_table, g_out, g_bias = (slope(at, y, text) for at in range(3))
            own = grams(text, config)
            out = out - rate * g_out
            bias = bias - 0.1 * rate * g_bias
            p = np.bincount(own, minlength=17) / len(own)
            seen += p * p
            used = p > 0
            table = table.copy()
            table[used] -= rate * g_table[used] / np.sqrt(seen[used])[:, None]
    got = K.train(sample, config)
    assert np.allclose(got.values, table @ (out[1] - out[0]), atol=1e-4)
    assert abs(got.bias - (bias[1] - bias[0])) < 1e-6
