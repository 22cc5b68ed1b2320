import random

from trendlens.llm import near_duplicates as N


def brute(rows, width):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(N.shingles((text or "").encode().lower().split(), width))
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in ids:
        for j in ids:
            for a in sets[i]:
                for b in sets[j]:
                    if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                        x, y = find(i), find(j)
                        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_chains_and_edits_against_all_pairs(spark):
    draw = random.Random(5)
    rows, n = [], 0
    for family in range(12):
        words = [f"f{family}w{draw.randrange(400)}" for _ in range(60)]
        for _ in range(12):
            n += 1
            rows.append((n, " ".join(words)))
            # A chain: each text differs a little from the one before.
            for _ in range(draw.randrange(4)):
                words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (2, 5):
        want = brute(rows, width)
        got = {r.doc_id: r.component_id for r in N.near_duplicates(docs, width).collect()}
        assert got == want


def test_edge_rows(edge, nothing):
    out = N.near_duplicates(edge, 2).collect()
    assert len(out) == 11
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in out}
    assert by[1, 0] == (1, True) and by[2, 0] == (2, True) and by[3, 0] == (3, True)
    assert by[4, 1] == (4, True)
    assert by[6, 79] == (6, True) and by[7, 79] == (6, False) and by[8, 80] == (6, False)
    assert by[None, 79] == (None, True)
    assert N.near_duplicates(nothing, 2).collect() == []
    kept = N.keep_one(edge, 2)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["1", "2", "3", "4", "5", "6", "9"])
    assert N.keep_one(nothing).collect() == []


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    draw = random.Random(11)
    rows = []
    for family in range(15):
        words = [f"f{family}w{draw.randrange(500)}" for _ in range(70)]
        for _ in range(draw.randrange(1, 9)):
            # Ids repeat over families, some are null, rows repeat whole.
            rows += [(draw.choice([None, *range(20)]), " ".join(words))] * draw.choice([1, 1, 2])
            if draw.random() < 0.7:
                words[draw.randrange(70)] = f"new{draw.randrange(10**6)}"
    rows += [(3, ""), (3, ""), (None, None), (3, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    group = brute([(n, text) for n, (_, text) in enumerate(rows)], 5)
    best = {}
    for n, g in group.items():
        i = rows[n][0]
        best[g] = min(best.get(g, (True, 0, 10**9)), (i is None, i or 0, n))
    want = sorted((rows[n] for _, _, n in best.values()), key=str)
    assert sorted((tuple(r) for r in N.keep_one(docs).collect()), key=str) == want


def test_a_unique_text_survives_its_repeated_id(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base)), (5, " ".join([*base[:59], "x"])), (5, "a text of its own " * 9),
            (9, "twice " + " ".join(base[::-1])), (9, "twice " + " ".join(base[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in N.keep_one(docs).collect()) == [1, 5, 9]


def test_members_that_miss_the_hub_are_still_linked(spark):
    # Many edits of one base: pairs straddle the limit, the group is one.
    draw = random.Random(9)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for n in range(1, 60):
        words = list(base)
        for _ in range(6):
            words[draw.randrange(100)] = f"e{n}x{draw.randrange(1000)}"
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.near_duplicates(docs, 2).collect()}
    assert got == brute(rows, 2)
