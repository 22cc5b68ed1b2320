import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlens.llm import voronoi_search as V

SCHEMA = "vec_id long, embedding array<double>, row long, cell string"


def brute(rows, k, scale=1024):
    live = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            live.append((n, i, [math.floor(scale * x) for x in v]))
    out = []
    for n, i, q in live:
        if i is None or i % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0, j)
                        for m, j, v in live if m != n)
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:k])]
    return sorted(out, key=str)


def found(spark, rows, k=10, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    out = V.top_k(df, F.col("vec_id") % 100 == 0, k, **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def clustered(seed, n, width, spread):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    x = centres[draw.integers(0, 12, n)] * draw.uniform(0.2, 3, (n, 1))
    x += spread * draw.normal(size=(n, width))
    return [(k, v.tolist()) for k, v in enumerate(x)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_against_all_pairs(spark, spread):
    rows = clustered(1, 1200, 6, spread)
    rows += [(5000 + k, rows[7][1]) for k in range(300)] + [(5100, rows[7][1])]
    want = brute(rows, 10)
    assert found(spark, rows, pivots=16, chunk_rows=50, group_rows=3) == want
    assert found(spark, rows) == want


def test_bounds_leave_rows_out(spark):
    rows = clustered(2, 1000, 4, 0.01)
    # Equal norms, as embeddings have them: inner products order as distances.
    rows = [(i, (np.array(v) / np.linalg.norm(v)).tolist()) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    points = V.integer_vectors(df, F.col("vec_id") % 100 == 0, "vec_id", "embedding", 1024)
    space = V.choose_pivots(points, 32)
    cells, queries = V.in_cells(points, space, False), V.in_cells(
        points.where("query"), space, True)
    plan = V.make_plan(space, V.summary(cells, space, 5), V.summary(queries, space, 5), 5, 60, 2)
    groups = len({g for _, g, _, _ in plan.needs})
    assert groups >= 4
    assert V._dealt_rows(cells, plan).count() < 0.8 * groups * len(rows)
    assert V._dealt_queries(queries, plan, 5).count() < 0.8 * plan.chunks * 10


def test_large_numbers_are_exact(spark):
    draw = random.Random(3)
    rows = [(k, [draw.uniform(-9e5, 9e5) for _ in range(3)]) for k in range(120)]
    assert found(spark, rows, pivots=4) == brute(rows, 10)
    with pytest.raises(ValueError):
        found(spark, [(0, [1e12]), (1, [1.0])])


def test_edge_rows(spark):
    assert found(spark, []) == []
    rows = [(0, None), (100, [1.0, None]), (200, [1.0, math.nan]), (300, [math.inf, 1.0]),
            (400, [1.0, 0.5]), (400, [1.0, 0.5]), (None, [1.0, 0.5]), (1, [1.0]), (500, []),
            (2, [-0.0004, 2.0, 7.0]), (-100, [0.0, 0.0])]
    assert found(spark, rows, 4) == brute(rows, 4)
    assert found(spark, rows) == brute(rows, 10)
    assert found(spark, [(0, [1.0])]) == []
