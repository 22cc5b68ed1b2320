"""The sparse network: gradients against finite differences, rounds against plain
Adam steps, learning, persistence."""

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.operators import models as ML
from trendlens.operators import network as NN

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()),
                       T.StructField("y", T.DoubleType())])


def table(spark, n, width=6, seed=1):
    """Label: whether the first two features together are above 0; sparse and dense
    vectors alternate."""
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, width)) * (draw.random((n, width)) < 0.7)
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    rows = []
    for k in range(n):
        at = np.flatnonzero(x[k])
        vector = SparseVector(width, at, x[k][at]) if k % 2 else DenseVector(x[k])
        rows.append((k, vector, float(y[k])))
    return spark.createDataFrame(rows, SCHEMA), x, y


def test_gradient_against_finite_differences():
    draw = np.random.default_rng(2)
    weights = [w + draw.normal(scale=0.1, size=w.shape) for w in NN.drawn([7, 5, 4, 1], 3)]
    x, y = draw.normal(size=(9, 7)), (draw.random(9) < 0.5).astype(float)
    x[:, [1, 4]] = 0.0
    seen = np.array([0, 2, 3, 5, 6])
    masks = NN.dropout_masks((1, 2, 3), 9, (5, 4), 0.3)
    _, loss, _, grads = NN.gradient(weights, seen, x[:, seen], y, masks)
    whole = np.zeros_like(weights[0])
    whole[seen] = grads[0]
    for k, g in enumerate([whole, *grads[1:]]):
        for at in np.ndindex(g.shape):
            moved = [w.copy() for w in weights]
            moved[k][at] += 1e-6
            other = NN.losses(NN.forward(moved, seen, x[:, seen], masks)[1], y).sum()
            assert abs((other - loss) / 1e-6 - g[at]) < 1e-3


def test_gradients_add_up_over_features():
    draw = np.random.default_rng(4)
    weights = NN.drawn([5, 3, 1], 1)
    x, y = draw.normal(size=(6, 5)), np.array([0, 1, 1, 0, 1, 0.0])
    x[:3, 3:] = 0.0
    x[3:, :2] = 0.0
    whole = NN.gradient(weights, np.arange(5), x, y)
    parts = NN.added(NN.gradient(weights, np.arange(3), x[:3, :3], y[:3]),
                     NN.gradient(weights, np.arange(2, 5), x[3:, 2:], y[3:]))
    assert parts[0] == whole[0] and abs(parts[1] - whole[1]) < 1e-12
    for a, b in zip(parts[3], whole[3], strict=True):
        assert np.allclose(a, b)


def test_one_round_an_epoch_is_plain_adam(spark):
    df, x, y = table(spark, 90)
    got = NN.Network("features", "y", (4, 3), 0.0, 5, 99, rounds=1).fit(df, df, 6)
    weights = NN.drawn([6, 4, 3, 1], 42)
    adam = NN.Adam(weights, 1e-3 * (90 / 32) ** 0.5)
    for _ in range(5):
        n, _, _, sums = NN.gradient(weights, np.arange(6), x, y)
        weights = adam.step(weights, [g / n for g in sums])
    for a, b in zip(got.weights, weights, strict=True):
        assert np.allclose(a, b, atol=1e-9)


def test_learns_and_loads(spark, tmp_path):
    df, _, y = table(spark, 900)
    train, valid, test = (df.where(F.col("id") % 3 == k) for k in range(3))
    model = NN.Network("features", "y", (16, 8), 0.1, 40, 10, rounds=6, rate=5e-3).fit(
        train, valid, 6)
    scored = model.transform(test.withColumn("more", F.array(F.lit(1))))
    assert scored.columns == ["id", "features", "y", "more", "probability", "prediction"]
    rows = scored.orderBy("id").collect()
    assert np.mean([r["prediction"] == r["y"] for r in rows]) > 0.9
    assert all(abs(sum(r["probability"]) - 1) < 1e-12 for r in rows)
    loaded = ML.load_pipeline(ML.save_model(model, str(tmp_path / "network")))
    again = loaded.transform(test).orderBy("id").collect()
    assert [r["probability"] for r in again] == [r["probability"] for r in rows]


def test_no_rows_null_labels_and_empty_vectors(spark):
    df, _, _ = table(spark, 40)
    none = NN.Network("features", "y", (3,), epochs=2).fit(df.limit(0), df.limit(0), 6)
    assert none.transform(df).count() == 40 and none.transform(df.limit(0)).count() == 0
    nulls = df.withColumn("y", F.lit(None).cast("double"))
    assert all((a == b).all() for a, b in zip(
        NN.Network("features", "y", (3,), epochs=2).fit(nulls, nulls, 6).weights, none.weights,
        strict=True))
    empty = spark.range(3).select(F.lit(1.0).alias("y"), array_to_vector(
        F.array_repeat(F.lit(0.0), 6)).alias("features"))
    assert NN.Network("features", "y", (3,), epochs=2).fit(empty, empty, 6).transform(
        empty).count() == 3
