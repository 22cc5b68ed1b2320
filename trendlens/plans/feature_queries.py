"""Registered queries for fitted statistics, splits, metrics and exploratory
summaries (survey M1, M2, M4, W5, A3, A5-A7, F11, E1-E7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.operators import eda as E
from trendlens.operators import encode as EN
from trendlens.operators import metrics as M
from trendlens.operators import split as SP
from trendlens.operators.filters import threshold
from trendlens.plans.registry import register, table
from trendlens.plans.table_queries import R6, r6

SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _z_sql(c: str) -> str:
    return (f"{R6(f'({c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 OR s.s_{c} IS NULL THEN 1 '
                  f'ELSE s.s_{c} END')} AS z_{c[2:]}")


@register("standardize", f"""
WITH s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in SCALE_COLS)}
           FROM lineitem)
SELECT l_orderkey, l_linenumber, {', '.join(_z_sql(c) for c in SCALE_COLS)}
FROM lineitem, s
""")
def standardize(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    model = EN.fit_scaler(li, SCALE_COLS)
    z = model.transform(li, suffix="__z")
    return z.select("l_orderkey", "l_linenumber",
                    *[r6(F.col(c + "__z")).alias(f"z_{c[2:]}") for c in SCALE_COLS])


MOMENT_COLS = ["l_quantity", "l_discount", "l_tax"]


@register("moments", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {R6(f'avg({c})')} AS mean, {R6(f'stddev_pop({c})')} AS std "
    f"FROM lineitem" for c in MOMENT_COLS))
def moments(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    wide = EN.moments(li, MOMENT_COLS)
    return E.long_rows(wide, [F.struct(F.lit(c).alias("column_name"),
                                       r6(F.col(f"{c}__mean")).alias("mean"),
                                       r6(F.col(f"{c}__std")).alias("std"))
                              for c in MOMENT_COLS])


@register("label_encode", """
SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT)
  AS p_brand_encoded
FROM part
""")
def label_encode(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return EN.label_encode(p, "p_brand")


@register("label_encode_source", """
SELECT doc_id, source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS BIGINT) AS source_encoded
FROM documents
""")
def label_encode_source(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return EN.label_encode(d, "source")


@register("stratified_split", """
WITH c AS (SELECT toxic, count(*) AS n_c FROM labels GROUP BY toxic),
q0 AS (SELECT toxic, n_c, n_c // 5 AS base, n_c % 5 AS rem FROM c),
q1 AS (SELECT *, (sum(n_c) OVER () + 4) // 5 - sum(base) OVER () AS spare,
              row_number() OVER (ORDER BY rem DESC, toxic ASC NULLS FIRST) AS rk FROM q0),
q AS (SELECT toxic, base + CASE WHEN rk <= spare THEN 1 ELSE 0 END AS quota FROM q1),
r AS (SELECT doc_id, quality, toxic, row_number() OVER (
        PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id) AS rk
      FROM labels)
SELECT r.doc_id, r.quality, r.toxic, CASE WHEN r.rk <= q.quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN q ON r.toxic IS NOT DISTINCT FROM q.toxic
""")
def stratified_split(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    return SP.stratified_split(lab, "doc_id", "toxic", test_size=0.2, seed=42)


@register("random_split", """
WITH r AS (SELECT vec_id, label, row_number() OVER (
             ORDER BY md5(CAST(vec_id AS VARCHAR) || '|42'), vec_id) AS rk FROM embeddings)
SELECT vec_id, label, CASE WHEN rk <= ((SELECT count(*) FROM embeddings) + 4) // 5
                      THEN 'test' ELSE 'train' END AS split
FROM r
""")
def random_split(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return SP.random_split(emb, "vec_id", test_size=0.2, seed=42)


def _rule_predictions(spark, sf_dir):
    """(actual, predicted) pairs: toxic against a rule on quality (p = 1 - quality,
    thresholded strictly at 0.5)."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(F.col("toxic").alias("actual"),
                      threshold(F.lit(1.0) - F.col("quality"), 0.5).alias("predicted"))


_PAIRS_SQL = ("pr AS (SELECT toxic AS actual, "
              "CAST((1.0 - quality) > 0.5 AS INTEGER) AS predicted FROM labels)")


@register("confusion", f"""
WITH {_PAIRS_SQL}
SELECT actual, predicted, count(*) AS n FROM pr GROUP BY actual, predicted
""")
def confusion(spark, sf_dir):
    return M.confusion(_rule_predictions(spark, sf_dir), "actual", "predicted")


@register("classification_report", f"""
WITH {_PAIRS_SQL},
u AS (SELECT actual AS label FROM pr UNION SELECT predicted FROM pr),
cls AS (SELECT u.label,
          (SELECT count(*) FROM pr WHERE actual = u.label) AS support,
          (SELECT count(*) FROM pr WHERE predicted = u.label) AS n_pred,
          (SELECT count(*) FROM pr WHERE actual = u.label AND predicted = u.label) AS tp
        FROM u),
m AS (SELECT label, support, tp,
        CASE WHEN n_pred = 0 THEN 0.0 ELSE tp / n_pred END AS p,
        CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM cls),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM m),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(p) AS mp, avg(r) AS mr, avg(f1) AS mf,
          sum(p * support) AS wp, sum(r * support) AS wr, sum(f1 * support) AS wf FROM f)
SELECT CAST(label AS VARCHAR) AS label, {R6('p')} AS precision, {R6('r')} AS recall,
       {R6('f1')} AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', {R6('tp / n')}, {R6('tp / n')}, {R6('tp / n')}, CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', {R6('mp')}, {R6('mr')}, {R6('mf')}, CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', {R6('wp / n')}, {R6('wr / n')}, {R6('wf / n')}, CAST(n AS BIGINT)
FROM tot
""")
def classification_report(spark, sf_dir):
    rep = M.classification_report(_rule_predictions(spark, sf_dir), "actual", "predicted")
    return rep.select("label", r6(F.col("precision")).alias("precision"),
                      r6(F.col("recall")).alias("recall"), r6(F.col("f1")).alias("f1"), "support")


@register("regression_metrics", f"""
WITH e AS (SELECT l_discount AS y, l_discount - l_tax AS e FROM lineitem)
SELECT {R6('avg(e * e)')} AS mean_squared_error,
       {R6('CASE WHEN var_pop(y) = 0 THEN 0.0 ELSE 1 - sum(e * e) / (var_pop(y) * count(*)) END')}
         AS r2_score,
       {R6('avg(abs(e))')} AS mean_absolute_error,
       {R6('sqrt(avg(e * e))')} AS root_mean_squared_error
FROM e
""")
def regression_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    m = M.regression_metrics(li, "l_discount", "l_tax")
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


SUMMARY_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("summary_stats", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {R6(f'avg({c})')} AS mean, "
    f"{R6(f'stddev_samp({c})')} AS std, {R6(f'min({c})')} AS min, "
    f"{R6(f'quantile_cont({c}, 0.25)')} AS q25, {R6(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{R6(f'quantile_cont({c}, 0.75)')} AS q75, {R6(f'max({c})')} AS max FROM lineitem"
    for c in SUMMARY_COLS))
def summary_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = E.summary_stats(li, SUMMARY_COLS, exact=True)
    return s.select("column_name", "count",
                    *[r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "q25", "q50",
                                                      "q75", "max")])


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("correlation", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R6(f'corr({a}, {b})')} AS corr FROM lineitem"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def correlation(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    c = E.correlation(li, CORR_COLS)
    return c.select("col_a", "col_b", r6(F.col("corr")).alias("corr"))


@register("category_perf", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n,
       {R6('avg(l_quantity)')} AS avg_l_quantity, {R6('median(l_quantity)')} AS median_l_quantity,
       {R6('avg(l_discount)')} AS avg_l_discount, {R6('median(l_discount)')} AS median_l_discount
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def category_perf(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    g = E.category_perf(li, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"],
                        exact_median=True)
    return g.select("l_returnflag", "l_linestatus", "n",
                    *[r6(F.col(c)).alias(c) for c in g.columns if c.startswith(("avg_", "median_"))])


@register("histogram", f"""
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
x AS (SELECT CAST(least(floor((value - lo) / (hi - lo) * 10), 9) AS BIGINT) AS bucket, lo, hi
      FROM events, b WHERE value IS NOT NULL)
SELECT bucket, count(*) AS n, {R6('any_value(lo) + bucket * ((any_value(hi) - any_value(lo)) / 10)')}
         AS bucket_lo,
       {R6('any_value(lo) + (bucket + 1) * ((any_value(hi) - any_value(lo)) / 10)')} AS bucket_hi
FROM x GROUP BY bucket
""")
def histogram(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    h = E.histogram(e, "value", bins=10)
    return h.select("bucket", "n", r6(F.col("bucket_lo")).alias("bucket_lo"),
                    r6(F.col("bucket_hi")).alias("bucket_hi"))


@register("outliers_iqr", f"""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT event_id, {R6('least(greatest(value, lo), hi)')} AS value_clipped,
       CAST(value < lo OR value > hi AS INTEGER) AS is_outlier
FROM events, f
""")
def outliers_iqr(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "value")
    lo, hi = E.iqr_fences(e, "value", exact=True)
    return e.select("event_id", r6(E.clip_to("value", (lo, hi))).alias("value_clipped"),
                    ((F.col("value") < lo) | (F.col("value") > hi)).cast("int").alias("is_outlier"))


@register("length_vs_perf", f"""
SELECT CAST(floor(d.n_chars / 1000) * 1000 AS BIGINT) AS length_bucket, count(*) AS n,
       {R6('avg(l.quality)')} AS avg_quality, {R6('avg(l.toxic)')} AS avg_toxic
FROM documents d JOIN labels l USING (doc_id) GROUP BY 1
""")
def length_vs_perf(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = d.join(table(spark, sf_dir, "labels"), "doc_id")
    g = E.length_vs_perf(j, "n_chars", ["quality", "toxic"], bucket_width=1000)
    return g.select("length_bucket", "n", r6(F.col("avg_quality")).alias("avg_quality"),
                    r6(F.col("avg_toxic")).alias("avg_toxic"))


# ---- TF-IDF -------------------------------------------------------------------

def _doc_words(spark, sf_dir):
    from trendlens.functions import text as T
    from trendlens.functions.stopwords import stop_words
    d = table(spark, sf_dir, "documents", "doc_id")
    return d.select("doc_id", T.remove_stopwords(T.clean_words("text"),
                                                 stop_words()).alias("words"))


def _tfidf_sql_prefix() -> str:
    from trendlens.plans import sqlfrag as S
    return f"""
w AS (SELECT doc_id, {S.tokens(S.remove_stopwords(S.word_list(S.clean_text('text'))))} AS toks
      FROM documents),
t AS (SELECT doc_id, unnest(toks) AS term FROM w),
pd AS (SELECT doc_id, term, count(*) AS cnt FROM t GROUP BY doc_id, term),
st AS (SELECT term, sum(cnt) AS tf, count(*) AS df FROM pd GROUP BY term),
v AS (SELECT term, tf, df FROM st ORDER BY tf DESC, term LIMIT 10000),
n AS (SELECT count(*) AS n FROM documents)"""


register("tfidf_vocab", f"""
WITH {_tfidf_sql_prefix()}
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_index,
       CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df,
       {R6('ln((1.0 + n) / (1.0 + df)) + 1.0')} AS idf
FROM v, n
""")(lambda spark, sf_dir: _tfidf_vocab(spark, sf_dir))


def _tfidf_vocab(spark, sf_dir):
    from trendlens.operators.tfidf import fit_vocab
    words = _doc_words(spark, sf_dir)
    voc = fit_vocab(words, "doc_id", "words")
    return voc.table.select("term", "term_index", "tf", "df", r6(F.col("idf")).alias("idf"))


@register("tfidf_weights", f"""
WITH {_tfidf_sql_prefix()},
x AS (SELECT pd.doc_id, pd.term, pd.cnt * (ln((1.0 + n) / (1.0 + v.df)) + 1.0) AS w
      FROM pd JOIN v USING (term), n),
nn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM x GROUP BY doc_id)
SELECT x.doc_id, x.term, {R6('x.w / nn.norm')} AS weight FROM x JOIN nn USING (doc_id)
""")
def tfidf_weights(spark, sf_dir):
    from trendlens.operators.tfidf import doc_terms, fit_vocab, tfidf_long
    words = _doc_words(spark, sf_dir)
    terms = doc_terms(words, "doc_id", "words").checkpoint(eager=True)
    voc = fit_vocab(words, "doc_id", "words", terms=terms)
    return tfidf_long(words, "doc_id", "words", voc, terms=terms).select(
        "doc_id", "term", r6(F.col("weight")).alias("weight"))


@register("tfidf_vectors", f"""
WITH {_tfidf_sql_prefix()},
vi AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS term_index FROM v),
x AS (SELECT pd.doc_id, vi.term_index, pd.cnt * (ln((1.0 + n) / (1.0 + vi.df)) + 1.0) AS w
      FROM pd JOIN vi USING (term), n),
nn AS (SELECT doc_id, term_index, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
       FROM x),
agg AS (SELECT doc_id, count(*) AS nnz, sum(term_index * weight) AS checksum,
               sum(weight * weight) AS sq FROM nn GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(agg.nnz, 0) AS BIGINT) AS nnz,
       {R6('coalesce(agg.checksum, 0.0)')} AS checksum, {R6('coalesce(agg.sq, 0.0)')} AS sq_norm
FROM documents d LEFT JOIN agg USING (doc_id)
""")
def tfidf_vectors(spark, sf_dir):
    """M3 vector form (CountVectorizerModel + idf scaling + L2 Normalizer, as
    fed to the models), summarised per document so it can be compared with
    the long form."""
    from trendlens.operators.tfidf import fit_vocab, sparse_parts, tfidf_vectors as to_vectors
    words = _doc_words(spark, sf_dir)
    voc = fit_vocab(words, "doc_id", "words")
    vec = sparse_parts(to_vectors(words, "words", voc, "v").select("doc_id", "v"), "v")
    return vec.select(
        "doc_id", F.size("v_val").cast("long").alias("nnz"),
        r6(F.aggregate(F.zip_with("v_val", "v_idx", lambda x, i: x * i), F.lit(0.0),
                       lambda acc, y: acc + y)).alias("checksum"),
        r6(F.aggregate("v_val", F.lit(0.0), lambda acc, x: acc + x * x)).alias("sq_norm"))
