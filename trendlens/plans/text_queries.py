"""Registered text queries (survey X1-X11, U2, S4, W3) over documents, pages
and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.functions import patterns as P
from trendlens.functions import text as T
from trendlens.functions.stopwords import stop_words
from trendlens.operators.dedup import dedup_first, key_digest
from trendlens.plans import sqlfrag as S
from trendlens.plans.registry import register, table


def lang_profile(spark, sf_dir):
    """Flagship: clean -> words -> keep-first dedup on (lang, words) ->
    labels left join -> per-language profile."""
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "lang", "text")
    words = docs.select("doc_id", "lang", T.clean_text("text").alias("text_cleaned"),
                        T.clean_words("text").alias("words"))
    # The wide key becomes a digest here; a few numbers per document go on.
    feats = words.select(
        "doc_id", "lang", F.length("text_cleaned").alias("text_length"),
        F.size("words").cast("long").alias("n_words"),
        T.join_words("words").alias("words_str"))
    feats = feats.select("doc_id", "lang", "text_length", "n_words",
                         key_digest(feats, ["lang", "words_str"]).alias("key"))
    kept = dedup_first(feats, keys=["key"], order=["doc_id"])
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = kept.join(labels, on="doc_id", how="left")
    return j.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_words").cast("long").alias("n_words"),
        F.round(F.avg("text_length"), 6).alias("avg_length"),
        F.count("quality").alias("n_labelled"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("n_toxic"),
    )


register("lang_profile", f"""
WITH w AS (
  SELECT doc_id, lang, {S.clean_text('text')} AS text_cleaned FROM documents),
f AS (
  SELECT doc_id, lang, text_cleaned, {S.word_list('text_cleaned')} AS words FROM w),
d AS (
  SELECT doc_id, lang, text_cleaned, len(words) AS n_words FROM f
  QUALIFY row_number() OVER (PARTITION BY lang, {S.join_words('words')} ORDER BY doc_id) = 1)
SELECT d.lang, count(*) AS n_docs, CAST(sum(n_words) AS BIGINT) AS n_words,
       round(avg(length(text_cleaned)), 6) AS avg_length,
       count(l.quality) AS n_labelled, CAST(coalesce(sum(l.toxic), 0) AS BIGINT) AS n_toxic
FROM d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang
""")(lang_profile)


@register("text_clean", f"""
SELECT doc_id, {S.clean_text('text')} AS text_cleaned,
       CAST(length({S.clean_text('text')}) AS BIGINT) AS text_length
FROM documents
""")
def text_clean(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id")
    c = d.select("doc_id", T.clean_text("text").alias("text_cleaned"))
    return c.select("doc_id", "text_cleaned",
                    F.length("text_cleaned").cast("long").alias("text_length"))


@register("text_clean_turns", f"""
SELECT conv_id, turn, role, {S.clean_text('text')} AS text_cleaned,
       CAST(length({S.clean_text('text')}) AS BIGINT) AS text_length
FROM conversations
""")
def text_clean_turns(spark, sf_dir):
    d = table(spark, sf_dir, "conversations", "conv_id")
    c = T.clean_text("text")
    return d.select("conv_id", "turn", "role", c.alias("text_cleaned"),
                    F.length(c).cast("long").alias("text_length"))


@register("extract_urls", f"""
WITH u AS (
  SELECT page_id, list_concat({S.extract('url', P.URL)}, {S.extract('html', P.URL)}) AS urls
  FROM pages)
SELECT page_id, CAST(len(urls) AS BIGINT) AS n_urls, array_to_string(urls, ' ') AS urls
FROM u
""")
def extract_urls(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id")
    urls = F.concat(T.extract_urls("url"), T.extract_urls("html"))
    return p.select("page_id", F.size(urls).cast("long").alias("n_urls"),
                    F.array_join(urls, " ").alias("urls"))


@register("extract_emojis", f"""
WITH u AS (
  SELECT page_id, list_concat({S.extract('url', P.EMOJI)}, {S.extract('html', P.EMOJI)}) AS em,
         {S.strip_emojis(S.strip_urls('html'))} AS stripped
  FROM pages)
SELECT page_id, CAST(len(em) AS BIGINT) AS n_emoji_runs, array_to_string(em, ' ') AS emojis,
       CAST(length(stripped) AS BIGINT) AS stripped_length
FROM u
""")
def extract_emojis(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id")
    em = F.concat(T.extract_emojis("url"), T.extract_emojis("html"))
    return p.select("page_id", F.size(em).cast("long").alias("n_emoji_runs"),
                    F.array_join(em, " ").alias("emojis"),
                    F.length(T.strip_emojis(T.strip_urls("html"))).cast("long")
                     .alias("stripped_length"))


@register("word_features", f"""
WITH w AS (SELECT doc_id, {S.word_list(S.clean_text('text'))} AS words FROM documents)
SELECT doc_id, CAST(len(words) AS BIGINT) AS word_count, {S.join_words('words')} AS words_str
FROM w
""")
def word_features(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id")
    w = d.select("doc_id", T.clean_words("text").alias("words"))
    return w.select("doc_id", F.size("words").cast("long").alias("word_count"),
                    T.join_words("words").alias("words_str"))


@register("stopword_filter", f"""
WITH w AS (SELECT doc_id, {S.word_list(S.clean_text('text'))} AS words FROM documents),
k AS (SELECT doc_id, words, {S.remove_stopwords('words')} AS kept FROM w)
SELECT doc_id, {S.join_words('kept')} AS kept_str,
       CAST(len(words) - len(kept) AS BIGINT) AS n_removed
FROM k
""")
def stopword_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id")
    words = d.select("doc_id", T.clean_words("text").alias("words"))
    kept = words.withColumn("kept", T.remove_stopwords("words", stop_words()))
    return kept.select("doc_id", T.join_words("kept").alias("kept_str"),
                       (F.size("words") - F.size("kept")).cast("long").alias("n_removed"))


@register("scrub_newlines", """
SELECT doc_id, translate(text, chr(10) || chr(13), '  ') AS text_scrubbed,
       CAST(length(text) - length(replace(replace(text, chr(10), ''), chr(13), '')) AS BIGINT)
         AS n_breaks
FROM documents
""")
def scrub_newlines(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id")
    breaks = F.length("text") - F.length(F.translate("text", "\n\r", ""))
    return d.select("doc_id", T.scrub_newlines("text").alias("text_scrubbed"),
                    breaks.cast("long").alias("n_breaks"))
