"""Registered neighbour and clustering queries over embeddings (survey J3-J5,
W4, T3, M12-M16, A8-A11, F7-F10, X20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.operators import cluster as CL
from trendlens.operators import neighbors as NB
from trendlens.operators.joins import attach_details, lookup_items
from trendlens.plans.registry import register, table
from trendlens.plans.table_queries import R6, r6

K = 5
DIM = 64
# Test-scale DBSCAN parameters for the 64-d unit embeddings (the reference
# uses eps 2.32 / min_samples 3 on its 7 PCA components).
EPS = 1.12
MIN_SAMPLES = 3

_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


_KNN_ROW_SQL = f"""
WITH {_PTS},
p AS (SELECT a.id AS query_id, b.id AS neighbor_id,
             1 - list_cosine_similarity(a.v, b.v) AS distance FROM pts a, pts b),
c AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS r
      FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY r) AS rank FROM c
      WHERE r <= {K + 1} AND neighbor_id <> query_id)
"""


@register("knn_by_row", f"""{_KNN_ROW_SQL}
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, {R6('1 - distance')} AS similarity
FROM k WHERE rank <= {K}
""")
def knn_by_row(spark, sf_dir):
    nb = NB.knn_by_row(_emb(spark, sf_dir), "vec_id", "embedding", K)
    return nb.select("query_id", "rank", "neighbor_id", r6(F.col("similarity")).alias("similarity"))


@register("recommend_details", f"""{_KNN_ROW_SQL}
SELECT k.query_id, CAST(k.rank AS INTEGER) AS rank, k.neighbor_id, d.lang, d.source, d.n_chars,
       {R6('1 - k.distance')} AS similarity
FROM k JOIN documents d ON d.doc_id = k.neighbor_id WHERE k.rank <= {K}
""")
def recommend_details(spark, sf_dir):
    nb = NB.knn_by_row(_emb(spark, sf_dir), "vec_id", "embedding", K)
    docs = table(spark, sf_dir, "documents")
    j = attach_details(nb, docs, "neighbor_id", "doc_id", ["lang", "source", "n_chars"])
    return j.select("query_id", "rank", "neighbor_id", "lang", "source", "n_chars",
                    r6(F.col("similarity")).alias("similarity"))


@register("knn_by_id", f"""
WITH pts AS (SELECT e.vec_id AS id, md5(d.text) AS item, CAST(e.embedding AS DOUBLE[]) AS v
             FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id),
f AS (SELECT item, min(id) AS query_id FROM pts GROUP BY item),
p AS (SELECT f.query_id, f.item AS query_item, b.id AS neighbor_id, b.item AS neighbor_item,
             1 - list_cosine_similarity(a.v, b.v) AS distance
      FROM f JOIN pts a ON a.id = f.query_id, pts b),
c AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS r
      FROM p),
k AS (SELECT * FROM c WHERE r <= {K + 1} AND neighbor_item <> query_item
      QUALIFY row_number() OVER (PARTITION BY query_id, neighbor_item ORDER BY r) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY r) AS rank FROM k)
SELECT query_id, query_item, CAST(rank AS INTEGER) AS rank, neighbor_id, neighbor_item,
       {R6('1 - distance')} AS similarity
FROM z WHERE rank <= {K}
""")
def knn_by_id(spark, sf_dir):
    """Items are document contents (exact copies share an item id, like one
    video trending on several days)."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"),
                                                     F.md5("text").alias("item"))
    pts = _emb(spark, sf_dir).join(docs, "vec_id")
    nb = NB.knn_by_id(pts, "vec_id", "item", "embedding", K)
    return nb.select("query_id", "query_item", "rank", "neighbor_id", "neighbor_item",
                     r6(F.col("similarity")).alias("similarity"))


@register("lookup_ids", """
SELECT l.doc_id, CAST(l.doc_id IN (SELECT vec_id FROM embeddings) AS INTEGER) AS found
FROM labels l
""")
def lookup_ids(spark, sf_dir):
    """Requested ids found in the index (semi join) or reported
    missing (anti join)."""
    emb = _emb(spark, sf_dir).select(F.col("vec_id").alias("doc_id"))
    req = table(spark, sf_dir, "labels").select("doc_id")
    found, missing = lookup_items(emb, req, "doc_id")
    return found.select("doc_id", F.lit(1).alias("found")).unionByName(
        missing.select("doc_id", F.lit(0).alias("found")))


@register("eps_join", f"""
WITH {_PTS}
SELECT a.id AS src, b.id AS dst, {R6('list_distance(a.v, b.v)')} AS distance
FROM pts a JOIN pts b ON a.id <> b.id AND list_distance(a.v, b.v) <= {EPS}
""")
def eps_join(spark, sf_dir):
    e = CL.eps_join(_emb(spark, sf_dir), "vec_id", "embedding", EPS, DIM)
    return e.select("src", "dst", r6(F.col("distance")).alias("distance"))


_DBSCAN_SQL = f"""
WITH RECURSIVE {_PTS},
nb AS (SELECT a.id AS src, b.id AS dst FROM pts a JOIN pts b ON list_distance(a.v, b.v) <= {EPS}),
core AS (SELECT src AS id FROM nb GROUP BY src HAVING count(*) >= {MIN_SAMPLES}),
ce AS (SELECT nb.src, nb.dst FROM nb WHERE src IN (SELECT id FROM core)
       AND dst IN (SELECT id FROM core)),
reach(id, root) AS (SELECT src, dst FROM ce
                    UNION SELECT r.id, ce.dst FROM reach r JOIN ce ON r.root = ce.src),
comp AS (SELECT id, min(root) AS label FROM reach GROUP BY id),
border AS (SELECT nb.src AS id, min(comp.label) AS label FROM nb JOIN comp ON nb.dst = comp.id
           WHERE nb.src NOT IN (SELECT id FROM core) GROUP BY nb.src),
allc AS (SELECT * FROM comp UNION ALL SELECT * FROM border),
codes AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS cl
          FROM (SELECT DISTINCT label FROM comp)),
lab AS (SELECT p.id AS vec_id, CAST(coalesce(codes.cl, -1) AS INTEGER) AS cluster_label
        FROM pts p LEFT JOIN allc ON allc.id = p.id LEFT JOIN codes ON codes.label = allc.label)
"""


def _dbscan(spark, sf_dir):
    return CL.dbscan(_emb(spark, sf_dir), "vec_id", "embedding", EPS, MIN_SAMPLES, DIM)


@register("dbscan", _DBSCAN_SQL + "SELECT vec_id, cluster_label FROM lab")
def dbscan(spark, sf_dir):
    return _dbscan(spark, sf_dir)


@register("cluster_counts", _DBSCAN_SQL + """
SELECT CAST(count(DISTINCT cluster_label) FILTER (WHERE cluster_label <> -1) AS BIGINT) AS n_clusters,
       CAST(count(*) FILTER (WHERE cluster_label = -1) AS BIGINT) AS n_noise FROM lab
""")
def cluster_counts(spark, sf_dir):
    return CL.cluster_counts(_dbscan(spark, sf_dir))


@register("silhouette", f"""
WITH pts AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS dsum,
             count(*) AS cnt
      FROM pts a JOIN pts b ON a.id <> b.id GROUP BY a.id, a.label, b.label),
own AS (SELECT id, dsum / cnt AS a FROM d WHERE other = label),
oth AS (SELECT id, min(dsum / cnt) AS b FROM d WHERE other <> label GROUP BY id),
s AS (SELECT p.id, CASE WHEN own.a IS NULL OR oth.b IS NULL THEN 0.0
                        ELSE (oth.b - own.a) / greatest(own.a, oth.b) END AS s
      FROM pts p LEFT JOIN own ON own.id = p.id LEFT JOIN oth ON oth.id = p.id)
SELECT {R6('avg(s)')} AS silhouette_score FROM s
""")
def silhouette(spark, sf_dir):
    s = CL.silhouette(_emb(spark, sf_dir), "vec_id", "embedding", "label", DIM)
    return s.select(r6(F.col("silhouette_score")).alias("silhouette_score"))


_DIMS_SQL = """
pts AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT id, label, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM pts),
cen AS (SELECT label, dim, avg(x) AS mu FROM x GROUP BY label, dim)
"""


@register("calinski_harabasz", f"""
WITH {_DIMS_SQL},
g AS (SELECT dim, avg(x) AS mu FROM x GROUP BY dim),
n AS (SELECT count(*) AS n, count(DISTINCT label) AS k FROM pts),
cnt AS (SELECT label, count(*) AS n_c FROM pts GROUP BY label),
b AS (SELECT sum(cnt.n_c * (cen.mu - g.mu) * (cen.mu - g.mu)) AS b
      FROM cen JOIN g USING (dim) JOIN cnt USING (label)),
w AS (SELECT sum((x.x - cen.mu) * (x.x - cen.mu)) AS w FROM x JOIN cen USING (label, dim))
SELECT {R6('(b.b / (n.k - 1)) / (w.w / (n.n - n.k))')} AS calinski_harabasz_score FROM b, w, n
""")
def calinski_harabasz(spark, sf_dir):
    c = CL.calinski_harabasz(_emb(spark, sf_dir), "embedding", "label")
    return c.select(r6(F.col("calinski_harabasz_score")).alias("calinski_harabasz_score"))


@register("davies_bouldin", f"""
WITH {_DIMS_SQL},
cv AS (SELECT label, list(mu ORDER BY dim) AS c FROM cen GROUP BY label),
sp AS (SELECT p.label, avg(list_distance(p.v, cv.c)) AS s FROM pts p JOIN cv USING (label)
       GROUP BY p.label),
pr AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.c, b.c)) AS worst
       FROM cv a JOIN cv b ON a.label <> b.label JOIN sp sa ON sa.label = a.label
       JOIN sp sb ON sb.label = b.label GROUP BY a.label)
SELECT {R6('avg(worst)')} AS davies_bouldin_score FROM pr
""")
def davies_bouldin(spark, sf_dir):
    d = CL.davies_bouldin(_emb(spark, sf_dir), "embedding", "label", DIM)
    return d.select(r6(F.col("davies_bouldin_score")).alias("davies_bouldin_score"))


@register("dbscan_evaluation", _DBSCAN_SQL + f""",
p2 AS (SELECT p.id, lab.cluster_label AS label, p.v FROM pts p JOIN lab ON lab.vec_id = p.id
       WHERE lab.cluster_label <> -1),
sd AS (SELECT a.id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS dsum,
              count(*) AS cnt
       FROM p2 a JOIN p2 b ON a.id <> b.id GROUP BY a.id, a.label, b.label),
own AS (SELECT id, dsum / cnt AS a FROM sd WHERE other = label),
oth AS (SELECT id, min(dsum / cnt) AS b FROM sd WHERE other <> label GROUP BY id),
sil AS (SELECT avg(CASE WHEN own.a IS NULL OR oth.b IS NULL THEN 0.0
                        ELSE (oth.b - own.a) / greatest(own.a, oth.b) END) AS sil
        FROM p2 LEFT JOIN own ON own.id = p2.id LEFT JOIN oth ON oth.id = p2.id),
x AS (SELECT id, label, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM p2),
cen AS (SELECT label, dim, avg(x) AS mu FROM x GROUP BY label, dim),
g AS (SELECT dim, avg(x) AS mu FROM x GROUP BY dim),
nn AS (SELECT count(*) AS n, count(DISTINCT label) AS k FROM p2),
cnt AS (SELECT label, count(*) AS n_c FROM p2 GROUP BY label),
bb AS (SELECT sum(cnt.n_c * (cen.mu - g.mu) * (cen.mu - g.mu)) AS b
       FROM cen JOIN g USING (dim) JOIN cnt USING (label)),
ww AS (SELECT sum((x.x - cen.mu) * (x.x - cen.mu)) AS w FROM x JOIN cen USING (label, dim)),
ch AS (SELECT (bb.b / (nn.k - 1)) / (ww.w / (nn.n - nn.k)) AS ch FROM bb, ww, nn),
cv AS (SELECT label, list(mu ORDER BY dim) AS c FROM cen GROUP BY label),
sp AS (SELECT p2.label, avg(list_distance(p2.v, cv.c)) AS s FROM p2 JOIN cv USING (label)
       GROUP BY p2.label),
pw AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.c, b.c)) AS worst
       FROM cv a JOIN cv b ON a.label <> b.label JOIN sp sa ON sa.label = a.label
       JOIN sp sb ON sb.label = b.label GROUP BY a.label),
db AS (SELECT avg(worst) AS db FROM pw),
cc AS (SELECT count(DISTINCT cluster_label) FILTER (WHERE cluster_label <> -1) AS n_clusters,
              count(*) FILTER (WHERE cluster_label = -1) AS n_noise FROM lab)
SELECT CAST(n_clusters AS BIGINT) AS n_clusters, CAST(n_noise AS BIGINT) AS n_noise,
       CAST({EPS} AS DOUBLE) AS eps, CAST({MIN_SAMPLES} AS INTEGER) AS min_samples,
       'euclidean' AS metric, 'auto' AS algorithm,
       CASE WHEN n_clusters > 1 THEN {R6('sil')} END AS silhouette_score,
       CASE WHEN n_clusters > 1 THEN {R6('ch')} END AS calinski_harabasz_score,
       CASE WHEN n_clusters > 1 THEN {R6('db')} END AS davies_bouldin_score
FROM cc, sil, ch, db
""")
def dbscan_evaluation(spark, sf_dir):
    """The reference's metrics bundle for the DBSCAN labels."""
    emb = _emb(spark, sf_dir)
    labels = CL.dbscan(emb, "vec_id", "embedding", EPS, MIN_SAMPLES, DIM)
    ev = CL.cluster_evaluation(emb, labels, "vec_id", "embedding", DIM, EPS, MIN_SAMPLES)
    scores = ("silhouette_score", "calinski_harabasz_score", "davies_bouldin_score")
    return ev.select(*[r6(F.col(c)).alias(c) if c in scores else F.col(c) for c in ev.columns])
