"""Properties from the survey's test strategy (§5 item 3)."""

import math

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")


def test_dedup_idempotent(spark):
    from trendlens.operators.dedup import dedup_first
    p = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    once = dedup_first(p, ["p_brand", "p_name"], ["p_partkey"])
    twice = dedup_first(once, ["p_brand", "p_name"], ["p_partkey"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == once.select("p_brand", "p_name").distinct().count()


def test_standardize_moments_and_constant(spark):
    from trendlens.operators.encode import standardize
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("k", F.lit(3.0))
    z = standardize(li, ["l_quantity", "k"])
    r = z.agg(F.avg("l_quantity").alias("m"), F.stddev_pop("l_quantity").alias("s"),
              F.max(F.abs("k")).alias("k")).first()
    assert abs(r["m"]) < 1e-9 and abs(r["s"] - 1) < 1e-9 and r["k"] == 0.0


def test_cyclic_unit_circle(spark):
    from trendlens.functions.dates import cyclic
    df = spark.range(0, 40).select(*cyclic(F.col("id"), 7))
    for s, c in df.collect():
        assert abs(s * s + c * c - 1) < 1e-12


def test_label_encoding_dense(spark):
    from trendlens.operators.encode import fit_label_encoder
    p = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    codes = fit_label_encoder(p, "p_brand").orderBy("p_brand").collect()
    assert [r["p_brand_encoded"] for r in codes] == list(range(len(codes)))


def test_rank_within_matches_window(spark):
    from pyspark.sql import Window
    from trendlens.operators.rank import rank_within
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    a = rank_within(li, ["l_returnflag"], ["l_orderkey", "l_linenumber"], out="r",
                    num_partitions=5)
    w = Window.partitionBy("l_returnflag").orderBy("l_orderkey", "l_linenumber")
    b = li.withColumn("r", F.row_number().over(w))
    key = ["l_orderkey", "l_linenumber", "r"]
    assert sorted(a.select(*key).collect()) == sorted(b.select(*key).collect())


def test_split_sizes_exact(spark):
    from trendlens.operators.split import stratified_split
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    s = stratified_split(lab, "doc_id", "toxic")
    n = lab.count()
    n_test = s.filter("split = 'test'").count()
    assert n_test == math.ceil(0.2 * n)
    per = {r["toxic"]: (r["t"], r["n"]) for r in s.groupBy("toxic").agg(
        F.count_if(F.col("split") == "test").alias("t"), F.count("*").alias("n")).collect()}
    for t, c in per.values():
        assert math.floor(0.2 * c) <= t <= math.floor(0.2 * c) + 1


def test_report_zero_division_and_accuracy(spark):
    from trendlens.operators.metrics import classification_report
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 0)], "a int, p int")
    rep = {r["label"]: r for r in classification_report(df, "a", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1"] == 0.0
    assert abs(rep["accuracy"]["f1"] - rep["weighted avg"]["recall"]) < 1e-12


def test_knn_self_similarity(spark):
    from trendlens.operators.neighbors import cosine_topk
    e = _emb(spark)
    top1 = cosine_topk(e, e, "vec_id", "embedding", 1).collect()
    assert all(r["query_id"] == r["neighbor_id"] and abs(r["distance"]) < 1e-9 for r in top1)


def test_dbscan_invariant_to_partitioning(spark):
    from trendlens.operators.cluster import dbscan
    e = _emb(spark)
    a = dbscan(e, "vec_id", "embedding", 1.12, 3, 64).collect()
    b = dbscan(e.repartition(3), "vec_id", "embedding", 1.12, 3, 64, tile_rows=64).collect()
    assert sorted(a) == sorted(b)


def test_dbscan_border_goes_to_lower_cluster(spark):
    from trendlens.operators.cluster import cluster_counts, dbscan
    pts = [(10 + i, [0.1 * i, 0.0]) for i in range(4)] + \
          [(i, [3.1 + 0.1 * i, 0.0]) for i in range(4)] + [(100, [1.7, 0.0])]
    df = spark.createDataFrame(pts, "id long, v array<double>")
    lab = {r["id"]: r["cluster_label"] for r in dbscan(df, "id", "v", 1.45, 4, 2).collect()}
    assert lab[0] == 0 and lab[10] == 1 and lab[100] == 0
    noise = dbscan(df, "id", "v", 0.01, 2, 2)
    c = cluster_counts(noise).first()
    assert c["n_clusters"] == 0 and c["n_noise"] == 9


def test_tfidf_vector_matches_long_form(spark):
    from pyspark.ml.functions import vector_to_array
    from trendlens.functions import text as T
    from trendlens.operators.tfidf import fit_vocab, tfidf_long, tfidf_vectors
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    w = d.select("doc_id", T.word_list(T.clean_text("text")).alias("words"))
    voc = fit_vocab(w, "doc_id", "words", max_features=300)
    long = {(r["doc_id"], r["term_index"]): r["weight"]
            for r in tfidf_long(w, "doc_id", "words", voc).collect()}
    vec = tfidf_vectors(w, "words", voc, "v").select("doc_id", vector_to_array("v").alias("a"))
    for r in vec.collect():
        for i, x in enumerate(r["a"]):
            assert abs(x - long.get((r["doc_id"], i), 0.0)) < 1e-9


def test_silhouette_same_for_blocks_of_any_size(spark):
    from trendlens.operators.cluster import silhouette
    e = _emb(spark)
    whole = silhouette(e, "vec_id", "embedding", "label", 64).first()[0]
    split = silhouette(e, "vec_id", "embedding", "label", 64, tile_rows=32).first()[0]
    assert abs(whole - split) < 1e-12


def test_bounded_broadcast_only_under_bound(spark):
    import io, contextlib
    from trendlens.operators.joins import bounded_broadcast
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")

    def plan(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(bounded_broadcast(small, 100), "k"))
        assert "BroadcastHashJoin" not in plan(small.join(bounded_broadcast(big, 100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ensure_parallelism(spark):
    from trendlens.operators.partitioning import ensure_parallelism
    one = spark.range(0, 100, numPartitions=1)
    many = spark.range(0, 100, numPartitions=16)
    target = spark.sparkContext.defaultParallelism
    assert ensure_parallelism(one, "id").rdd.getNumPartitions() == target
    assert ensure_parallelism(many, "id").rdd.getNumPartitions() == 16


def test_splits_of_repeated_and_null_ids(spark):
    from trendlens.operators.split import random_split, stratified_split
    rows = [(k % 30 if k % 11 else None, "ab"[k % 2], float(k)) for k in range(100)]
    df = spark.createDataFrame(rows, "id long, label string, x double")
    for split in (random_split(df, "id"), stratified_split(df, "id", "label")):
        got = split.collect()
        assert sorted(r.x for r in got) == sorted(float(k) for k in range(100))
        assert sum(r.split == "test" for r in got) == 20
        assert split.columns == ["id", "label", "x", "split"]
