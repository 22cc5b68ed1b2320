"""Registered queries for dates, numeric features, filters, lookups, dedup,
JSON, unions (survey X12-X22, F1-F5, J1, W1-W3, A1, A2, T1, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.functions import dates as D
from trendlens.functions import numeric as N
from trendlens.functions import text as T
from trendlens.operators import dedup as DD
from trendlens.operators import filters as FL
from trendlens.operators.joins import with_lookup
from trendlens.plans import sqlfrag as S
from trendlens.plans.registry import register, table


def r6(c):
    """Round to 6 places; ``+ 0.0`` turns a negative zero into zero."""
    return F.round(c, 6) + F.lit(0.0)


def R6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


@register("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS order_year,
       CAST(month(o_orderdate) AS BIGINT) AS order_month,
       CAST(day(o_orderdate) AS BIGINT) AS order_day,
       CAST(hour(o_orderdate) AS BIGINT) AS order_hour,
       CAST(o_orderdate AS DATE) AS order_date,
       CAST(isodow(o_orderdate) - 1 AS BIGINT) AS order_day_of_week
FROM orders
""")
def date_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    return o.select("o_orderkey", F.year(ts).cast("long").alias("order_year"),
                    F.month(ts).cast("long").alias("order_month"),
                    F.dayofmonth(ts).cast("long").alias("order_day"),
                    F.hour(ts).cast("long").alias("order_hour"),
                    F.to_date(ts).alias("order_date"),
                    D.day_of_week(ts).cast("long").alias("order_day_of_week"))


@register("parse_iso_ts", """
WITH s AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM events),
p AS (SELECT event_id, iso, CAST(strptime(iso, '%Y-%m-%dT%H:%M:%S.%gZ') AS TIMESTAMP) AS t FROM s)
SELECT event_id, iso, CAST(year(t) AS BIGINT) AS y, CAST(hour(t) AS BIGINT) AS h,
       CAST(minute(t) AS BIGINT) AS mi, CAST(CAST(t AS DATE) AS DATE) AS d
FROM p
""")
def parse_iso_ts(spark, sf_dir):
    """ISO-8601 text with a zone designator (the publish_time format)
    parsed to a UTC timestamp; parts read back in UTC."""
    e = table(spark, sf_dir, "events")
    s = e.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"))
    t = D.parse_iso_ts("iso")
    return s.select("event_id", "iso", F.year(t).cast("long").alias("y"),
                    F.hour(t).cast("long").alias("h"), F.minute(t).cast("long").alias("mi"),
                    F.to_date(t).alias("d"))


@register("parse_trending_date", """
WITH s AS (SELECT o_orderkey, strftime(o_orderdate, '%y.%d.%m') AS trending_str FROM orders),
p AS (SELECT o_orderkey, trending_str, CAST(strptime(trending_str, '%y.%d.%m') AS DATE) AS d
      FROM s)
SELECT o_orderkey, trending_str, d AS trending_date,
       CAST(year(d) AS BIGINT) AS trending_year, CAST(month(d) AS BIGINT) AS trending_month,
       CAST(day(d) AS BIGINT) AS trending_day,
       CAST(isodow(d) - 1 AS BIGINT) AS trending_day_of_week
FROM p
""")
def parse_trending_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    s = o.select("o_orderkey",
                 F.date_format("o_orderdate", "yy.dd.MM").alias("trending_str"))
    d = D.parse_trending("trending_str")
    p = s.withColumn("trending_date", d)
    td = F.col("trending_date")
    return p.select("o_orderkey", "trending_str", "trending_date",
                    F.year(td).cast("long").alias("trending_year"),
                    F.month(td).cast("long").alias("trending_month"),
                    F.dayofmonth(td).cast("long").alias("trending_day"),
                    D.day_of_week(td).cast("long").alias("trending_day_of_week"))


@register("days_between", """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT)
         AS days_to_ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def days_between(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                              "o_orderdate")
    j = li.join(o, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber",
                    D.days_between("l_shipdate", "o_orderdate").cast("long").alias("days_to_ship"))


def _cyc_sql(x: str, p: int, name: str) -> str:
    a = f"(2 * pi() * CAST({x} AS DOUBLE) / {float(p)})"
    return f"{R6(f'sin({a})')} AS {name}_sin, {R6(f'cos({a})')} AS {name}_cos"


@register("cyclic_features", f"""
SELECT o_orderkey,
  {_cyc_sql('month(o_orderdate)', 12, 'month')},
  {_cyc_sql('day(o_orderdate)', 31, 'day')},
  {_cyc_sql('hour(o_orderdate)', 24, 'hour')},
  {_cyc_sql('isodow(o_orderdate) - 1', 7, 'day_of_week')}
FROM orders
""")
def cyclic_features(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    parts = {"month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
             "day_of_week": D.day_of_week(ts)}
    cols = []
    for name, x in parts.items():
        s, c = D.cyclic(x, D.CYCLE_PERIODS[name])
        cols += [r6(s).alias(f"{name}_sin"), r6(c).alias(f"{name}_cos")]
    return o.select("o_orderkey", *cols)


# Event types playing the roles of views / likes / dislikes / comments.
EVENT_ROLES = {"view": "views", "click": "likes", "error": "dislikes", "purchase": "comments"}


@register("ratio_features", f"""
WITH p AS (
  SELECT user_id,
         count(*) FILTER (WHERE event_type = 'view') AS views,
         count(*) FILTER (WHERE event_type = 'click') AS likes,
         count(*) FILTER (WHERE event_type = 'error') AS dislikes,
         count(*) FILTER (WHERE event_type = 'purchase') AS comments
  FROM events GROUP BY user_id)
SELECT user_id, views, likes, dislikes, comments,
  {R6('CAST(likes AS DOUBLE) / (CAST(dislikes AS DOUBLE) + 1.0)')} AS like_dislike_ratio,
  {R6('CAST(likes AS DOUBLE) / (CAST(views AS DOUBLE) + 1.0)')} AS like_view_ratio,
  {R6('CAST(comments AS DOUBLE) / (CAST(views AS DOUBLE) + 1.0)')} AS comment_view_ratio
FROM p
""")
def ratio_features(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type")
    # Pivot over a fixed value list: no extra job to discover the values.
    p = e.groupBy("user_id").pivot("event_type", list(EVENT_ROLES)).count()
    p = p.select("user_id", *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(v)
                              for k, v in EVENT_ROLES.items()])
    return p.select("*", r6(N.ratio("likes", "dislikes")).alias("like_dislike_ratio"),
                    r6(N.ratio("likes", "views")).alias("like_view_ratio"),
                    r6(N.ratio("comments", "views")).alias("comment_view_ratio"))


@register("log_features", f"""
SELECT l_orderkey, l_linenumber,
  {R6('ln(1 + l_quantity)')} AS log_quantity,
  {R6('ln(1 + l_extendedprice)')} AS log_extendedprice,
  {R6('ln(1 + l_discount)')} AS log_discount
FROM lineitem
""")
def log_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     r6(N.log1p("l_quantity")).alias("log_quantity"),
                     r6(N.log1p("l_extendedprice")).alias("log_extendedprice"),
                     r6(N.log1p("l_discount")).alias("log_discount"))


@register("json_props", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", N.json_int("props", "$.k").alias("k"))


def _docs_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


# Test stand-ins for the reference's invalid-id marker and dropped category ids.
BAD_SOURCE = "src0"
DROPPED_TOXIC = (1,)


@register("filter_invalid", """
SELECT d.doc_id, d.source, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE NOT coalesce(d.source = 'src0', false) AND NOT coalesce(l.toxic IN (1), false)
""")
def filter_invalid(spark, sf_dir):
    j = _docs_labels(spark, sf_dir)
    j = FL.drop_values(j, "source", [BAD_SOURCE])
    j = FL.drop_values(j, "toxic", DROPPED_TOXIC)
    return j.select("doc_id", "source", "toxic")


@register("impute_null", """
SELECT d.doc_id,
       coalesce(CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, 'unknown')
         AS quality_label
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def impute_null(spark, sf_dir):
    j = _docs_labels(spark, sf_dir)
    q = j.select("doc_id", F.when(F.col("quality") == 1, "good")
                 .when(F.col("quality") == 0, "poor").alias("quality_label"))
    return FL.impute_const(q, {"quality_label": "unknown"})


@register("null_profile", """
WITH j AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT column_name, CAST(n_null AS BIGINT) AS n_null, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT 'doc_id' AS column_name, count(*) FILTER (WHERE doc_id IS NULL) AS n_null, count(*) AS n_rows FROM j
  UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL), count(*) FROM j
  UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NULL), count(*) FROM j
  UNION ALL SELECT 'n_chars', count(*) FILTER (WHERE n_chars IS NULL), count(*) FROM j
  UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL), count(*) FROM j
  UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), count(*) FROM j)
""")
def null_profile(spark, sf_dir):
    from trendlens.operators.eda import null_profile as np_
    return np_(_docs_labels(spark, sf_dir))


@register("flags_to_int", """
SELECT doc_id, CAST(CAST(quality AS BOOLEAN) AS INTEGER) AS quality,
       CAST(CAST(toxic AS BOOLEAN) AS INTEGER) AS toxic
FROM labels
""")
def flags_to_int(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("boolean").alias("quality"),
        F.col("toxic").cast("boolean").alias("toxic"))
    return FL.flags_to_int(lab, ["quality", "toxic"])


@register("category_lookup", """
SELECT c.c_custkey, c.c_nationkey, n.n_name, r.r_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def category_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                              "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    lookup = with_lookup(n, r, ["n_regionkey"]).drop("n_regionkey")
    return with_lookup(c, lookup, ["c_nationkey"])


@register("union_regions", """
SELECT event_id, user_id, ts, NULL::DOUBLE AS value, NULL::VARCHAR AS props, event_type
FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, user_id, NULL::TIMESTAMP, value, NULL::VARCHAR, event_type
FROM events WHERE event_type = 'view'
UNION ALL
SELECT event_id, NULL::BIGINT, NULL::TIMESTAMP, NULL::DOUBLE, props, event_type
FROM events WHERE event_type NOT IN ('click', 'view')
""")
def union_regions(spark, sf_dir):
    """Slices with different column sets, concatenated by name."""
    e = table(spark, sf_dir, "events")
    a = e.filter("event_type = 'click'").select("event_id", "user_id", "ts", "event_type")
    b = e.filter("event_type = 'view'").select("event_type", "value", "event_id", "user_id")
    c = e.filter("event_type NOT IN ('click', 'view')").select("props", "event_id", "event_type")
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


# ---- duplicates -------------------------------------------------------------

@register("dup_mark", """
SELECT doc_id, count(*) OVER (PARTITION BY text) AS dup_count,
       CAST(count(*) OVER (PARTITION BY text) > 1 AS INTEGER) AS is_duplicate
FROM documents
""")
def dup_mark(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return DD.dup_mark(d, ["text"]).select("doc_id", "dup_count", "is_duplicate")


@register("dup_summary", """
WITH g AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY p_brand, p_name)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_rows_after_dedup,
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_duplicate_groups,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_duplicate_rows,
       CAST(count(DISTINCT n) FILTER (WHERE n > 1) AS BIGINT) AS n_distinct_group_sizes
FROM g
""")
def dup_summary(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return DD.dup_summary(p, ["p_brand", "p_name"])


@register("dup_sorted", """
SELECT p_partkey, p_brand, p_name, count(*) OVER (PARTITION BY p_brand, p_name) AS dup_count
FROM part QUALIFY count(*) OVER (PARTITION BY p_brand, p_name) > 1
""")
def dup_sorted(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    return DD.duplicates_sorted(p, ["p_brand", "p_name"])


@register("dedup_first", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) = 1
""")
def dedup_first(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return DD.dedup_first(p, ["p_brand", "p_name"], ["p_partkey"])


@register("dedup_docs", f"""
WITH w AS (SELECT doc_id, source, {S.join_words(S.word_list(S.clean_text('text')))} AS words_str
           FROM documents)
SELECT doc_id, source, CAST(length(words_str) AS BIGINT) AS words_length FROM w
QUALIFY row_number() OVER (PARTITION BY source, words_str ORDER BY doc_id) = 1
""")
def dedup_docs(spark, sf_dir):
    """Keep-first on (source, cleaned word string) — the reference's
    (channel, title words) key shape, over whole texts."""
    d = table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", "source", T.join_words(T.clean_words("text")).alias("words_str"))
    # Words are measured and digested where they are; neither is exchanged.
    narrow = d.select("doc_id", "source", F.length("words_str").cast("long").alias("words_length"),
                      DD.key_digest(d, ["source", "words_str"]).alias("key"))
    return DD.dedup_first(narrow, ["key"], ["doc_id"]).drop("key")


# ---- requested rows and ids -----------------------------------------------------

_POSITIONS = "SELECT DISTINCT s_suppkey * 7 - 14 AS position FROM supplier"


@register("lookup_by_position", f"""
WITH p AS ({_POSITIONS}),
r AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT p.position, r.doc_id, r.lang, r.doc_id IS NULL AS out_of_range
FROM p LEFT JOIN r ON r.position = p.position
""")
def lookup_by_position(spark, sf_dir):
    """F8: documents by 0-based position, bad positions reported."""
    from trendlens.operators.joins import lookup_rows
    from trendlens.operators.rank import rank_within
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = rank_within(docs, [], ["doc_id"], out="position").withColumn(
        "position", F.col("position") - 1)
    asked = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 7 - 14).alias("position"))
    found, bad = lookup_rows(rows, asked, "position", "position")
    found = found.select("position", "doc_id", "lang", F.lit(False).alias("out_of_range"))
    return found.unionByName(bad.withColumn("out_of_range", F.lit(True)),
                             allowMissingColumns=True)


@register("lookup_unknown_ids", """
SELECT DISTINCT p_partkey AS vec_id FROM part
WHERE p_partkey NOT IN (SELECT vec_id FROM embeddings)
""")
def lookup_unknown_ids(spark, sf_dir):
    """requested ids that no item has, reported instead of dropped."""
    from trendlens.operators.joins import lookup_items
    asked = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vec_id"))
    return lookup_items(table(spark, sf_dir, "embeddings").select("vec_id"), asked, "vec_id")[1]
