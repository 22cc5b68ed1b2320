"""Registered model queries (survey M4-M11, S9, A6, A7).  Fitted models have
no SQL oracle; the driver records a rows-only check and the tests assert
quality floors (beat the majority class / the mean predictor)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from trendlens.operators import metrics as M
from trendlens.operators import models as ML
from trendlens.operators import split as SP
from trendlens.plans.feature_queries import SCALE_COLS, _doc_words
from trendlens.plans.registry import ORACLE, register, table
from trendlens.plans.table_queries import R6, r6
from trendlens.session import scratch_path

PCA_K = 7


def _report(scored, actual, predicted):
    rep = M.classification_report(scored, actual, predicted)
    return rep.select("label", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")],
                      "support")


@register("pca")
def pca(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    res = ML.fit_pca(emb, "embedding", PCA_K)
    out = res.transform(emb, "embedding", "pca")
    return out.select("vec_id", *[r6(F.col("pca")[i]).alias(f"pc_{i + 1}") for i in range(PCA_K)])


def _doc_features(spark, sf_dir, max_features: int = 10000):
    """Documents with stop-word-free words, TF-IDF vector and numerics."""
    from trendlens.functions import text as T
    from trendlens.functions.stopwords import stop_words
    from trendlens.operators.tfidf import fit_vocab, tfidf_vectors
    d = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "lang", "n_chars", "text")
    w = d.select("doc_id", "lang", "n_chars",
                 T.remove_stopwords(T.clean_words("text"), stop_words()).alias("words"))
    w = w.withColumns({"log_chars": F.log1p("n_chars"),
                       "n_words": F.size("words").cast("double"),
                       "distinct_ratio": F.size(F.array_distinct("words"))
                       / F.greatest(F.size("words"), F.lit(1))}).checkpoint(eager=True)
    voc = fit_vocab(w, "doc_id", "words", max_features)
    return tfidf_vectors(w, "words", voc, "text_tfidf")


def _category_model(spark, sf_dir):
    """M6: document language from TF-IDF + a numeric feature — the reference's
    category-from-text-and-numerics shape."""
    df = _doc_features(spark, sf_dir)
    split = SP.stratified_split(df, "doc_id", "lang", 0.2, 42)
    # Read by every step of the fit and by the report: vectors are made once.
    feats = ML.assemble(split, ["log_chars", "text_tfidf"]).select(
        "doc_id", "lang", "split", "features").checkpoint(eager=True)
    train = feats.filter("split = 'train'")
    model = ML.logistic_regression("features", "lang", train.count()).fit(train)
    return model, feats.filter("split = 'test'")


@register("logreg_category")
def logreg_category(spark, sf_dir):
    """M6 + A6: multinomial classifier report on the held-out documents."""
    model, test = _category_model(spark, sf_dir)
    scored = ML.finish_labels(model, model.transform(test))
    return _report(scored, "lang", "prediction")


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """S9 + M10: save the fitted pipeline to the shared folder, load it back
    and predict the held-out rows -> (Actual, Predicted)."""
    model, test = _category_model(spark, sf_dir)
    path = ML.save_model(model, scratch_path(spark, "logreg"))
    loaded = ML.load_pipeline(path)
    scored = ML.finish_labels(loaded, loaded.transform(test))
    return ML.predictions(scored, "lang")


#: Terms that the network sees of the documents' vocabulary.
MLP_TEXT_WIDTH = 128


def _toxic_model(spark, sf_dir):
    from trendlens.operators.encode import fit_scaler
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic").where("toxic IS NOT NULL")
    df = _doc_features(spark, sf_dir).join(lab, "doc_id")
    cols = ["log_chars", "n_words", "distinct_ratio"]
    df = ML.assemble(fit_scaler(df, cols).transform(df), cols, "numbers")
    df = df.select("doc_id", "toxic", "numbers", "text_tfidf").checkpoint(eager=True)
    split = SP.stratified_split(df, "doc_id", "toxic", 0.2, 42)
    train_all = split.filter("split = 'train'").drop("split")
    inner = SP.stratified_split(train_all, "doc_id", "toxic", 0.2, 7)
    fit = inner.filter("split = 'train'")
    prepare = ML.text_and_numbers(["text_tfidf"], MLP_TEXT_WIDTH, "toxic").fit(fit)
    shown = prepare.transform(fit).checkpoint(eager=True)
    model = ML.train_mlp(shown, prepare.transform(inner.filter("split = 'test'")), "features",
                         "toxic", shown.first()["features"].size)
    return PipelineModel(stages=[*prepare.stages, model]), split.filter("split = 'test'")


def _toxic_report(model, test):
    from pyspark.ml.functions import vector_to_array
    from trendlens.operators.filters import threshold
    pred = model.transform(test).withColumn(
        "pred", threshold(vector_to_array("probability")[1], 0.5))
    return _report(pred, "toxic", "pred")


@register("mlp_toxic")
def mlp_toxic(spark, sf_dir):
    """M7 + F11 + A6: binary network on numerics and TF-IDF terms of labelled
    documents, early-stopped on a validation split carved from the training
    rows (never the test rows)."""
    return _toxic_report(*_toxic_model(spark, sf_dir))


@register("mlp_roundtrip")
def mlp_roundtrip(spark, sf_dir):
    """The network's pipeline saved, loaded back and applied."""
    model, test = _toxic_model(spark, sf_dir)
    path = ML.save_model(model, scratch_path(spark, "mlp"))
    return _toxic_report(ML.load_pipeline(path), test)


@register("pca_roundtrip")
def pca_roundtrip(spark, sf_dir):
    """The projection saved, loaded back and applied."""
    emb = table(spark, sf_dir, "embeddings")
    path = ML.save_pca(spark, ML.fit_pca(emb, "embedding", PCA_K), scratch_path(spark, "pca"))
    out = ML.load_pca(spark, path).transform(emb, "embedding", "pca")
    return out.select("vec_id", *[r6(F.col("pca")[i]).alias(f"pc_{i + 1}") for i in range(PCA_K)])


def _lineitem_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax", F.year("l_shipdate").alias("ship_year"),
                     F.month("l_shipdate").alias("ship_month"),
                     (F.col("l_extendedprice") / (F.col("l_quantity") + 1)).alias("unit_ratio"))


def _gbt(spark, sf_dir, target, features, saved: bool = False):
    from trendlens.operators.encode import fit_scaler
    df = _lineitem_features(spark, sf_dir)
    df = df.withColumn("row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    # Targets are standardised first, as in the reference.
    df = fit_scaler(df, [target]).transform(df, suffix="_z")
    split = SP.random_split(df, "row_key", 0.2, 42)
    feats = ML.assemble(split, features)
    model = ML.gbt_regressor("features", f"{target}_z").fit(feats.filter("split = 'train'"))
    if saved:
        model = ML.load_pipeline(ML.save_model(model, scratch_path(spark, "gbt")))
    scored = model.transform(feats.filter("split = 'test'"))
    m = M.regression_metrics(scored, f"{target}_z", "prediction")
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


@register("gbt_likes")
def gbt_likes(spark, sf_dir):
    """M8: boosted trees for a standardised amount; like the reference's likes
    model (fed the like/dislike ratio and dislikes) it sees the amount's ratio
    and denominator among its features."""
    return _gbt(spark, sf_dir, "l_extendedprice",
                ["l_quantity", "unit_ratio", "l_discount", "l_tax", "ship_year", "ship_month"])


@register("gbt_ratio")
def gbt_ratio(spark, sf_dir):
    """M9: boosted trees for a standardised ratio whose parts are features
    (the reference's ratio model has the same leak)."""
    return _gbt(spark, sf_dir, "unit_ratio",
                ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("gbt_roundtrip")
def gbt_roundtrip(spark, sf_dir):
    """The trees saved, loaded back and applied."""
    return _gbt(spark, sf_dir, "unit_ratio",
                ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], saved=True)


# ---- what SQL can state of fitted models ------------------------------------------

@register("scaler_roundtrip", ORACLE["standardize"])
def scaler_roundtrip(spark, sf_dir):
    """The scaler saved as a table and as a pipeline stage, loaded and applied."""
    from trendlens.operators.encode import ScalerModel, fit_scaler
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    fitted = fit_scaler(li, SCALE_COLS)
    model = ScalerModel.load(spark, fitted.save(spark, scratch_path(spark, "scaler")))
    saved = ML.save_model(model.stage("__z"), scratch_path(spark, "scaler-stage"))
    z = ML.load_pipeline(saved).transform(li)
    return z.select("l_orderkey", "l_linenumber",
                    *[r6(F.col(c + "__z")).alias(f"z_{c[2:]}") for c in SCALE_COLS])


@register("codes_roundtrip", ORACLE["label_encode"])
def codes_roundtrip(spark, sf_dir):
    """The label codes saved, loaded and applied."""
    from trendlens.operators import encode as EN
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    path = EN.save_codes(EN.fit_label_encoder(p, "p_brand"), scratch_path(spark, "codes"))
    return EN.label_encode(p, "p_brand", codes=EN.load_codes(spark, path))


@register("vectorizer_roundtrip", ORACLE["tfidf_weights"])
def vectorizer_roundtrip(spark, sf_dir):
    """The vocabulary saved as a table, the vectoriser made of what was loaded
    saved as a pipeline, loaded and applied; its vectors by term."""
    from trendlens.operators.tfidf import (fit_vocab, load_vocab, save_vocab, sparse_parts,
                                          vector_stages)
    words = _doc_words(spark, sf_dir)
    path = save_vocab(fit_vocab(words, "doc_id", "words"), scratch_path(spark, "vocab"))
    vocab = load_vocab(spark, path)
    stages = PipelineModel(stages=vector_stages("words", vocab, "v"))
    model = ML.load_pipeline(ML.save_model(stages, scratch_path(spark, "vectorizer")))
    parts = sparse_parts(model.transform(words).select("doc_id", "v"), "v")
    cells = parts.select("doc_id", F.inline(F.arrays_zip("v_idx", "v_val")))
    # At most max_features terms.
    terms = F.broadcast(vocab.table.select("term", F.col("term_index").cast("int").alias("v_idx")))
    return cells.join(terms, "v_idx").select("doc_id", "term", r6(F.col("v_val")).alias("weight"))


@register("saved_pipeline", """
SELECT lang, count(*) AS n_rows, count(*) AS n_same FROM documents GROUP BY lang
""")
def saved_pipeline(spark, sf_dir):
    """Scaler, vectoriser, assembler and classifier as one pipeline
    from words and numbers to a prediction, saved and loaded; every document is
    predicted by both."""
    from pyspark.ml.feature import VectorAssembler
    from trendlens.operators.encode import fit_scaler
    from trendlens.operators.tfidf import fit_vocab, vector_stages
    d = table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", "lang", F.log1p("n_chars").alias("log_chars"))
    d = d.join(_doc_words(spark, sf_dir), "doc_id").checkpoint(eager=True)
    before = [fit_scaler(d, ["log_chars"]).stage("_z"),
              *vector_stages("words", fit_vocab(d, "doc_id", "words", 500), "text"),
              VectorAssembler(inputCols=["log_chars_z", "text"], outputCol="features")]
    shown = PipelineModel(stages=before).transform(d)
    fitted = ML.logistic_regression("features", "lang", d.count(), max_iter=20).fit(shown)
    model = PipelineModel(stages=[*before, *fitted.stages])
    loaded = ML.load_pipeline(ML.save_model(model, scratch_path(spark, "whole-pipeline")))
    first = model.transform(d).select("doc_id", "lang", F.col("__pred_idx").alias("a"))
    again = loaded.transform(d).select("doc_id", F.col("__pred_idx").alias("b"))
    return first.join(again, "doc_id").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("a") == F.col("b")).alias("n_same"))


@register("logreg_shares", f"""
SELECT lang, count(*) AS n_rows, {R6('count(*) / (SELECT count(*) FROM documents)')} AS share,
       true AS mean_probability_is_share
FROM documents GROUP BY lang
""")
def logreg_shares(spark, sf_dir):
    """M6: where the objective is least in the unpenalised intercepts, a class's mean
    probability over the training rows is its share of them."""
    from pyspark.ml.functions import vector_to_array
    df = _doc_features(spark, sf_dir, 300)
    feats = ML.assemble(df, ["log_chars", "text_tfidf"]).select("lang", "features").checkpoint(
        eager=True)
    n = feats.count()
    model = ML.logistic_regression("features", "lang", n, C=1.0).fit(feats)
    p = model.transform(feats).select("lang", vector_to_array("probability").alias("p"))
    labels = model.stages[0].labels
    means = p.agg(*[F.avg(F.col("p")[k]).alias(c) for k, c in enumerate(labels)])
    means = means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("__l"), F.col(f"`{c}`").alias("m"))
                                            for c in labels])))
    shares = feats.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.col("n_rows") / F.lit(n)
    return shares.join(means, F.col("lang") == F.col("__l")).select(
        "lang", "n_rows", r6(share).alias("share"),
        (F.abs(F.col("m") - share) < 1e-3).alias("mean_probability_is_share"))


@register("pca_variance", f"""
WITH x AS (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x,
                  generate_subscripts(embedding, 1) AS d FROM embeddings),
v AS (SELECT d, var_samp(x) AS v FROM x GROUP BY d)
SELECT count(*) AS n_components, {R6('sum(v)')} AS total_variance,
  CAST(0 AS DOUBLE) AS greatest_mean FROM v
""")
def pca_variance(spark, sf_dir):
    """All components together have the variance of the data, and mean 0."""
    emb = table(spark, sf_dir, "embeddings")
    width = emb.agg(F.max(F.size("embedding"))).first()[0]
    out = ML.fit_pca(emb, "embedding", width).transform(emb, "embedding", "pca")
    by = out.select(F.posexplode("pca").alias("d", "x")).groupBy("d").agg(
        F.var_samp("x").alias("v"), F.avg("x").alias("m"))
    return by.agg(F.count(F.lit(1)).alias("n_components"), r6(F.sum("v")).alias("total_variance"),
                  F.abs(r6(F.max(F.abs("m")))).alias("greatest_mean"))


_SPLIT_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@register("gbt_one_split", f"""
WITH f AS (SELECT CAST(unnest([{', '.join(_SPLIT_FEATURES)}]) AS DOUBLE) AS x,
                  unnest(range({len(_SPLIT_FEATURES)})) AS feature,
                  CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem),
g AS (SELECT feature, x, count(*) AS n, sum(y) AS s FROM f GROUP BY ALL),
c AS (SELECT feature, x, lead(x) OVER w AS above, sum(n) OVER w AS n, sum(s) OVER w AS s,
             sum(n) OVER (PARTITION BY feature) AS n_all, sum(s) OVER (PARTITION BY feature) AS s_all
      FROM g WINDOW w AS (PARTITION BY feature ORDER BY x)),
b AS (SELECT *, s * s / n + (s_all - s) * (s_all - s) / (n_all - n) AS gain FROM c
      WHERE above IS NOT NULL ORDER BY gain DESC LIMIT 1)
SELECT CAST(feature AS INTEGER) AS feature, {R6('(x + above) / 2')} AS threshold,
       {R6('s / n')} AS mean_below, {R6('(s_all - s) / (n_all - n)')} AS mean_above
FROM b
""")
def gbt_one_split(spark, sf_dir):
    """M8, M9: the boosted regressor with one tree of one split; the split and the
    means on both sides are the best there are."""
    li = table(spark, sf_dir, "lineitem").select(
        *_SPLIT_FEATURES, F.col("l_extendedprice").cast("double").alias("y"))
    feats = ML.assemble(li, _SPLIT_FEATURES)
    model = ML.gbt_regressor("features", "y", n_estimators=1, learning_rate=1.0,
                             num_leaves=2).fit(feats)
    a = model.arrays
    means = a["value"] + a["start"]
    row = (int(a["feature"][0]), float(a["threshold"][0]), float(means[a["left"][0]]),
           float(means[a["right"][0]]))
    out = spark.createDataFrame([row], "feature int, threshold double, mean_below double, "
                                       "mean_above double")
    return out.select("feature", *[r6(F.col(c)).alias(c) for c in out.columns[1:]])


@register("gbt_saved", """
SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) AS n_rows, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n_same
FROM lineitem
""")
def gbt_saved(spark, sf_dir):
    """Boosted trees of a small fit, saved and loaded; the held-out rows are
    predicted by both."""
    df = _lineitem_features(spark, sf_dir).withColumn(
        "row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    split = SP.random_split(df, "row_key", 0.2, 42)
    feats = ML.assemble(split, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).select(
        "row_key", "split", "features", "unit_ratio").checkpoint(eager=True)
    model = ML.gbt_regressor("features", "unit_ratio", n_estimators=3, num_leaves=8).fit(
        feats.where("split = 'train'"))
    loaded = ML.load_pipeline(ML.save_model(model, scratch_path(spark, "gbt-small")))
    both = loaded.transform(model.transform(feats.where("split = 'test'"))
                            .withColumnRenamed("prediction", "unsaved"))
    same = F.col("prediction") == F.col("unsaved")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same"))
