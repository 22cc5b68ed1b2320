import numpy as np
import pytest

from trendlens.operators.quantiles import group_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("buckets", [2, 1024])
def test_against_numpy(spark, buckets):
    draw = np.random.default_rng(1)
    groups = {"hot": np.r_[np.zeros(700), draw.normal(size=700) * 1e6],
              "wide": np.r_[10.0 ** draw.uniform(-200, 200, 60), -1e300, 1e300],
              "close": 1.0 + np.arange(9) * np.spacing(1.0), None: draw.integers(0, 4, 50) * 1.0,
              "one": np.array([3.5]), "two": np.array([1.0, 2.0])}
    rows = [(g, float(x), float(-2 * x)) for g, xs in groups.items() for x in xs]
    rows += [("hot", None, None), ("none", None, 1.0), ("hot", float("nan"), None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    if buckets == 2:
        df = df.where("g IS NULL OR g <> 'wide'")
        groups.pop("wide")
    got = {(r["g"], r["column_name"], r["prob"]): r["value"]
           for r in group_quantiles(df, ["g"], ["x", "y"], PROBS, buckets).collect()}
    assert ("none", "x", 0.5) not in got and got["none", "y", 0.5] == 1.0
    for g, xs in groups.items():
        for name, col in (("x", xs), ("y", -2 * xs)):
            for p in PROBS:
                assert np.isclose(got[g, name, p], np.quantile(col, p), rtol=1e-12, atol=0), (g, p)
    assert group_quantiles(df.where("false"), ["g"], ["x"], PROBS).collect() == []


def test_no_buffer_of_values(spark):
    import contextlib
    import io
    from trendlens.operators import eda
    df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS double) AS x")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        eda.category_perf(df, ["g"], ["x"], exact_median=True).explain("formatted")
        eda.summary_stats(df, ["x"], exact=True).explain("formatted")
    assert "percentile" not in out.getvalue() and "median(" not in out.getvalue()


def test_codes_of_a_hot_value_without_broadcast(spark, monkeypatch):
    from trendlens.operators import encode
    rows = [(k, "hot" if k % 2 else f"v{k % 70:03d}") for k in range(2000)] + [(2000, None)]
    df = spark.createDataFrame(rows, "id long, v string")
    want = {r["id"]: r["v_encoded"] for r in encode.label_encode(df, "v").collect()}
    monkeypatch.setattr(encode, "small", lambda *_: False)
    got = encode.label_encode(df, "v")
    assert {r["id"]: r["v_encoded"] for r in got.collect()} == want
    assert want[1] == 0 and want[0] == 1 and want[2000] is None and got.count() == 2001
