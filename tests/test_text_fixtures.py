"""Hand-written edge rows (FIXTURES.md §2) through the JVM expressions and the
Arrow-batched cleaner, which must agree."""

from pyspark.sql import functions as F

from trendlens.functions import text as T
from trendlens.functions.dates import day_of_week, days_between, parse_iso_ts, parse_trending

ROWS = [
    (1, "Zurück http://a.b/c 😀😀 NOW1"),
    (2, "x 日本 y"),
    (3, "a　b"),
    (4, "a b"),
    (5, 'a|"b c"|"d"'),
    (6, None),
    (7, "see www.example.com/x?q=1 now"),
    (8, "tab\tsep\x1cfs"),
]


def _df(spark):
    return spark.createDataFrame(ROWS, "id int, t string")


def _get(spark, expr):
    return {r["id"]: r["v"] for r in _df(spark).select("id", expr.alias("v")).collect()}


def test_clean_text(spark):
    got = _get(spark, T.clean_text("t"))
    assert got[1] == "zurck   now"
    assert got[2] == "x  y"
    assert got[3] == "ab"
    assert got[4] == "a b"
    assert got[5] == "ab cd"
    assert got[6] is None
    assert got[7] == "see  now"


def test_clean_variants_agree(spark):
    a = _get(spark, T.clean_text("t"))
    b = _get(spark, T.clean_text_stepwise("t"))
    assert a == b


def test_emojis_and_urls(spark):
    em = _get(spark, T.extract_emojis("t"))
    assert em[1] == ["😀😀"] and em[2] == ["日本"] and em[3] == ["　"] and em[6] == []
    urls = _get(spark, T.extract_urls("t"))
    assert urls[1] == ["http://a.b/c"] and urls[7] == ["www.example.com/x?q=1"] and urls[6] == []


def test_words(spark):
    wc = _get(spark, T.word_count(T.clean_text("t")))
    assert wc[5] == 2 and wc[6] == 0
    words = _get(spark, T.word_list(T.clean_text("t")))
    assert words[4] == ["a", "b"]
    assert words[8] == ["tab", "sep", "fs"]
    assert _get(spark, T.clean_words("t")) == words


def test_stopwords_and_tokens(spark):
    from trendlens.functions.stopwords import stop_words
    df = spark.createDataFrame([(["the", "a", "bb", "cat", "der", "x"],)], "w array<string>")
    r = df.select(T.remove_stopwords("w", stop_words()).alias("k"),
                  T.tokens("w").alias("t")).first()
    assert r["k"] == ["bb", "cat", "x"]
    assert r["t"] == ["the", "bb", "cat", "der"]


def test_dates(spark):
    df = spark.createDataFrame([("2017-11-13T17:13:01.000Z", "17.14.11"),
                                ("2017-11-13T17:13:01.000Z", "92.01.02")], "p string, t string")
    r = df.select(parse_iso_ts("p").alias("ts"), parse_trending("t").alias("d")).select(
        F.hour("ts").alias("h"), "d", day_of_week("d").alias("dow"),
        days_between("d", "ts").alias("days")).collect()
    assert str(r[0]["d"]) == "2017-11-14" and r[0]["dow"] == 1 and r[0]["days"] == 1
    assert r[0]["h"] == 17
    assert str(r[1]["d"]) == "1992-02-01"


def test_scrub_and_nulls(spark):
    from trendlens.operators.filters import normalize_nulls, scrub_string_columns
    df = spark.createDataFrame([("x\r\ny", "None"), ("ok", "NA"), ("a", "nan"), ("b", "")],
                               "a string, b string")
    out = scrub_string_columns(normalize_nulls(df)).collect()
    assert out[0]["a"] == "x  y"
    assert all(r["b"] is None for r in out)
