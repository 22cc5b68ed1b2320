import contextlib
import io

from pyspark.sql import functions as F

from trendlens.operators import dedup as DD


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def rows(spark):
    text = [("hot " * 50, None if k % 5 == 0 else "a") for k in range(600)]
    text += [(f"text {k % 200}", "a") for k in range(350)]
    text += [(None, None), (None, None), (None, "a"), ("", "a"), ("", None), ("a,1:b", "c"),
             ("a", "1:b,c")]
    data = [(k * 37 % 1009, t, s, k % 3, [k % 2]) for k, (t, s) in enumerate(text)]
    return spark.createDataFrame(data, "id long, text string, s string, n int, l array<int>")


def test_group_sizes_and_marks(spark):
    df = rows(spark)
    for keys in (["text"], ["text", "s"], ["l"], ["n", "l", "s"]):
        want = {}
        for r in df.collect():
            want.setdefault(tuple(map(str, (r[k] for k in keys))), []).append(r.id)
        got = DD.dup_mark(df, keys).collect()
        assert len(got) == df.count()
        for r in got:
            n = len(want[tuple(map(str, (r[k] for k in keys)))])
            assert (r.dup_count, r.is_duplicate) == (n, int(n > 1))
    assert DD.dup_mark(df.where("false"), ["text"]).collect() == []


def test_the_hot_group_is_dealt_and_texts_stay(spark):
    df = rows(spark).repartition(4, "id")
    counted = DD.group_count(df, ["text"]).select("id", "dup_count")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = DD.group_count(df, ["text"])
        hot = counted.where("dup_count = 600").select(F.spark_partition_id().alias("p"))
        assert hot.distinct().count() > 3
        shown = plan(counted.select("id", "dup_count"))
        exchanges = [x for x in shown.splitlines() if "Exchange" in x]
        assert exchanges and not any("text" in x for x in exchanges)
        assert "SortAggregate" not in shown
        assert "SortAggregate" not in plan(DD.dedup_first(df, ["text"], ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_first_of_each_group(spark):
    df = rows(spark)
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.n, r.id)):
        want.setdefault((r.text, r.s), r.id)
    for part in (df, df.repartition(7)):
        kept = DD.dedup_first(part, ["text", "s"], ["n", "id"])
        assert kept.columns == df.columns
        assert sorted(r.id for r in kept.collect()) == sorted(want.values())
    twin = df.union(df)
    assert DD.dedup_first(twin, ["text"], ["n"]).count() == DD.dedup_first(df, ["text"], ["n"]).count()
    a, b = [sorted(r.id for r in DD.dedup_first(x, ["text"], ["n"]).collect())
            for x in (df, df.repartition(5))]
    assert a == b
    assert DD.dedup_first(df.where("false"), ["text"], ["id"]).collect() == []
