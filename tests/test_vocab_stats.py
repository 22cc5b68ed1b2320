"""Term statistics counted where a document lies against (doc, term) counts."""

from trendlens.operators import tfidf as TF

ROWS = [(1, ["aa", "bb", "aa", "c"]), (2, ["bb"]), (2, ["bb", "cc"]), (None, ["aa"]),
        (None, ["aa", "dd"]), (3, []), (4, None), (5, ["cc", "cc"])]


def stats(df):
    return sorted(map(tuple, df.select("term", "tf", "df").collect()))


def test_same_as_by_document_and_term(spark):
    for rows in (ROWS, ROWS[:2], [r for r in ROWS if r[0]], ROWS[:0]):
        df = spark.createDataFrame(rows, "id long, words array<string>")
        assert stats(TF.corpus_stats(df, "id", "words")) == stats(
            TF.term_stats(TF.doc_terms(df, "id", "words")))


def test_documents_are_not_moved_by_term(spark):
    df = spark.range(100).selectExpr("id", "array('aa', 'bb') AS words").checkpoint()
    plan = TF.corpus_stats(df, "id", "words")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(term" in plan


def test_vectors_of_several_fields_are_made_where_the_row_lies(spark):
    rows = [(1, ["aa", "bb", "aa", "c"], ["x"]), (2, ["bb", "zz"], []), (3, [], ["y"])]
    df = spark.createDataFrame(rows, "id long, a array<string>, b array<string>").checkpoint()
    vocabs = {c: TF.fit_vocab(df, "id", c, 10) for c in ("a", "b")}
    parts = TF.tfidf_parts(df, ["a", "b"], vocabs)
    assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()
    got = {(r["id"], i): w for r in parts.collect()
           for i, w in zip(r["a_tfidf_idx"], r["a_tfidf_val"], strict=True)}
    long = {(r["id"], r["term_index"]): r["weight"]
            for r in TF.tfidf_long(df, "id", "a", vocabs["a"]).collect()}
    assert got.keys() == long.keys()
    assert all(abs(got[k] - long[k]) < 1e-12 for k in long)
    assert all(r["b_tfidf_idx"] == [] and r["b_tfidf_val"] == [] for r in parts.collect())
