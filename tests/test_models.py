"""Model quality floors (survey §5 item 4) and persistence."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_CHECK


def test_logreg_beats_majority(spark):
    rep = {r["label"]: r for r in E.queries()["logreg_category"](spark, SF_CHECK).collect()}
    support = [r["support"] for k, r in rep.items() if k not in ("accuracy", "macro avg",
                                                                   "weighted avg")]
    assert rep["accuracy"]["f1"] > max(support) / sum(support)


def test_gbt_beats_mean(spark):
    for name in ("gbt_likes", "gbt_ratio"):
        r = E.queries()[name](spark, SF_CHECK).first()
        assert r["r2_score"] > 0.0, name


def test_mlp_at_least_majority(spark):
    rep = {r["label"]: r for r in E.queries()["mlp_toxic"](spark, SF_CHECK).collect()}
    assert {"accuracy", "macro avg", "weighted avg"} <= set(rep)
    support = [r["support"] for k, r in rep.items() if k in ("0", "1")]
    assert rep["accuracy"]["f1"] >= max(support) / sum(support) - 0.05


def test_pca_orthonormal_components(spark):
    from trendlens.operators.models import fit_pca
    e = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    res = fit_pca(e, "embedding", 7)
    for i, a in enumerate(res.components):
        assert max(a, key=abs) > 0
        for j, b in enumerate(res.components):
            dot = sum(x * y for x, y in zip(a, b))
            assert abs(dot - (1.0 if i == j else 0.0)) < 1e-9


def test_model_roundtrip(spark):
    df = E.queries()["model_roundtrip"](spark, SF_CHECK)
    assert df.columns == ["Actual", "Predicted"] and df.count() == 200
    assert df.filter(F.col("Predicted").isNull()).count() == 0


def test_pca_query_schema(spark):
    from tests.conftest import SF_SMALL
    df = E.queries()["pca"](spark, SF_SMALL)
    assert df.columns == ["vec_id"] + [f"pc_{i}" for i in range(1, 8)]
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()


def test_category_features_are_made_once(spark):
    """The fit's steps and the report read stored vectors, they do not make them again."""
    from tests.conftest import SF_SMALL
    from trendlens.plans import model_queries as MQ
    from trendlens.session import prepare
    model, test = MQ._category_model(prepare(spark), SF_SMALL)
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Exchange" not in plan
    assert model.transform(test).count() == test.count() > 0
