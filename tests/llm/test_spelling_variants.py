import random
import re
import zlib
from collections import Counter

from trendlens.llm import spelling_variants as S


def brute_words(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(count):
    out = {}
    near = {w: [v for v in count if one_edit(v, w)] for w in count}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        if best is not None and count[best] < 10 * count[w]:
            best = None
        out[w] = best
    def last(w):
        while out[w]:
            w = out[w]
        return w
    return {w: (out[w], last(w), count[w], len(near[w]), out[w] and count[out[w]]) for w in count}


def found(docs):
    rows = S.spelling_variants(docs).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def drawn(seed, n):
    draw = random.Random(seed)
    syllables = ["an", "na", "te", "et", "ré", "er", "io", "s", "À"]
    base = ["".join(draw.choice(syllables) for _ in range(5)) for _ in range(n // 10)]
    out = []
    for k in range(n):
        word = draw.choice(base)
        if draw.random() < 0.7:
            at = draw.randrange(len(word))
            word = word[:at] + draw.choice("aeétr") + word[at + draw.randrange(2):]
        out.append((k, f"{word} {word} " * draw.choice([1, 1, 3, 40])))
    return out


def test_against_all_pairs(spark):
    rows = drawn(3, 600)
    count = brute_words(rows)
    assert len(count) > 250
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute(count)
    assert got == want
    assert any(r[0] for r in want.values()) and any(r[3] > 1 for r in want.values())


def test_large_buckets_are_signed_again(spark):
    count = brute_words(drawn(4, 500))
    vocabulary = spark.createDataFrame(list(count.items()), "word string, n long")
    want = {(a, b, count[b]) for a in count for b in count if one_edit(a, b)}
    for parts, bucket, block in ((4, 3, 2), (3, 8, 1), (6, 1024, 256)):
        got = [tuple(r) for r in S.near_pairs(vocabulary, parts, bucket, block).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_forms_are_followed_to_the_last(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zbcdefghij": 2000}
    rows = [(1, " ".join(f"{w} " * n for w, n in words.items()))]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(brute_words(rows))
    assert got["abcdefg"][:2] == ("abcdefgh", "abcdefghij")
    assert got["abcdefghij"] == (None, "abcdefghij", 2000, 2, None)


def test_edge_rows(spark, edge, nothing):
    assert found(nothing) == {}
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert found(edge) == brute(brute_words(rows))
    giant = "ab" * 3000
    rows = [(None, f"{giant} {giant}a"), (1, f"{giant} {giant}a É×÷ÀÿÉ×÷Àÿ É×÷ÀÿÉ×÷Àÿ"), (1, None)]
    rows += rows
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(brute_words(rows)) and got[giant][3] == 1
