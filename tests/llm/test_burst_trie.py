import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from trendlens.llm import burst_trie as B

SCHEMA = "conv_id long, turn long, role string, text string, key string, n long"


def rebuilt(rows, span=100, most=6):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            named = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()[:16]
            order = (turn is not None, turn or 0, named + len(text).to_bytes(4, "big"))
            convs[c].append((order, (role, text)))
    convs = {c: [t for _, t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        first = c - (abs(c) % span) * (1 if c >= 0 else -1)
        out[c] = convs.get(first, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in members.items():
        ids = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p],
                    leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = B.conversation_trie(df, **options)
    assert out.columns == B.COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def drawn(seed, n):
    """Long shared beginnings, groups of copies, and a very common first turn."""
    draw = random.Random(seed)
    stems = [[("user", f"stem{s} turn{k} é") for k in range(draw.randrange(1, 40))]
             for s in range(4)]
    rows = []
    for c in range(n):
        turns = [("system", "be kind")] * draw.randrange(2) + list(draw.choice(stems))
        if draw.random() < 0.6:
            turns = turns[:draw.randrange(1, 12)]
        turns += [("user", f"own{draw.randrange(3)}")] * draw.randrange(3)
        rows += [(c * 50, t, role, text) for t, (role, text) in enumerate(turns)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("page,container", [(16, 4096), (4, 3), (3, 1)])
def test_against_all_prefixes(spark, page, container):
    rows = drawn(1, 130)
    want = brute(rebuilt(rows))
    assert max(r[1] for r in want) > 30 and any(r[3] > 5 for r in want if r[1] > 10)
    assert found(spark, rows, page=page, container=container) == want


def test_rebuilt_turns(spark):
    rows = drawn(2, 60)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = defaultdict(list)
    for r in B.rebuilt_turns(B.ordered_turns(df)).collect():
        got[r.conv_id] += [] if r.pos is None else [(r.pos, bytes(r.entry))]
    want = rebuilt(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [p for p, _ in sorted(got[c])] == list(range(len(turns)))
        assert [int.from_bytes(e[16:], "big") for _, e in sorted(got[c])] == [
            len(t) for _, t in turns]


def test_digests_of_groups_over_many_ranges(spark):
    # One node ends most conversations, so its ids lie in all ranges.
    rows = [(c, 0, "user", "hello" if c % 7 else f"other{c}") for c in range(0, 300_00, 100)]
    rows += [(c, k, "user", f"{k}") for c in (100, 200) for k in range(1, 4)]
    assert found(spark, rows) == brute(rebuilt(rows))


def test_long_groups_come_out_as_pieces(spark, monkeypatch):
    monkeypatch.setattr(B, "_IDS", 2)
    rows = [(c, 0, "user", f"t{(c // 100) % 3}") for c in range(0, 100_000, 100)]
    assert found(spark, rows) == brute(rebuilt(rows))


def test_edge_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 1, "", ""),
            (3, 5, "user", "x" * 50_000), (None, 0, "user", "a"), (103, 0, "a", "b"),
            (100, 0, "u", "v"), (-5, 0, "a", "b"), (0, 2, "a:b", "c"), (0, 1, "a", "b:c"),
            (205, None, "user", None), (305, 3, "user", "\U0001f600é")]
    assert found(spark, rows) == brute(rebuilt(rows))
    one = [(4, 0, "user", "a")]
    assert found(spark, one) == brute(rebuilt(one))
