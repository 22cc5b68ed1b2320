"""Quality rules with adaptive thresholds (operator 8), DataFrame functions only.

Every document gets a few measures of its text.  For each language and source
a mergeable KLL quantile sketch of each measure is built with map-side partial
aggregation, over the documents that pass the base rule.  A measure's limit is a
tail quantile of the sketch and beyond it some times the tail's distance from the
median (``MEASURES``); there is no least spread or other constant that could
decide instead.  The limits are joined back and decide.

* A small source's quantiles are blended with those of its language's merged
  sketch, by a weight that grows smoothly with its documents.
* A source full of poor documents must not open its own limits: they are held by
  the limits of the language's sources, each source having one voice however many
  rows it has.  Two thirds of the sources lie within the hold; a source may exceed
  its distance from the sources' median by the factor ``widen`` only.

Nothing but sketches (a few kB a group) is gathered.

Edge cases: a null text is an empty one; an empty text fails the base rule; a
null language or source is a group of its own; repeated rows are measured and
returned one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import WHITE, lookup, text_of, words_of, written

#: Fixed value: characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Tail:
    """``at``: rank of the tail quantile.  ``times``: how many times the tail's
    distance from the median the limit lies beyond it.  ``both``: small values are
    judged likewise."""

    at: float
    times: float
    both: bool = False


#: Poor documents of every source must be fewer than a measure's tail holds, or
#: they set its limit.  Symbols and word lengths take a wide tail that lies inside
#: the usual documents; repetition is rare, so its tail is thin.
MEASURES = {"word_length": Tail(0.9, 5.0, both=True), "symbol_rate": Tail(0.9, 5.0),
            "dup_line_rate": Tail(0.975, 1.0), "repeat_rate": Tail(0.975, 1.0)}


@dataclass(frozen=True)
class RuleConfig:
    """``sketch_k``: size of a sketch (rank error about 1.7 / k^0.9).
    ``half_weight``: a source of so many documents weighs as much as its language
    in the blend of their quantiles.  ``sources``: share of a language's sources
    that lie within the hold.  ``widen``: how far past it a source may go."""

    sketch_k: int = 1024
    half_weight: int = 5
    sources: float = 0.66
    widen: float = 1.25
    measures: dict = field(default_factory=lambda: dict(MEASURES))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside 3-word windows that occur twice or
    more in the text.  Windows are compared by a 64-bit hash within one text.
    Needs ``__words``; sorting keeps a text at n log n."""
    w = F.col("__words")
    window = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    df = df.withColumn("__windows", window)
    win = F.col("__windows")
    pair = F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("__sorted", F.when(F.size(F.array_distinct(win)) < F.size(win),
                                          F.sort_array(pair)))
    s = F.col("__sorted")
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"])
                     | (x["h"] == F.get(s, i + 1)["h"]))
    df = df.withColumn("__starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    p = F.col("__starts")
    covered = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x,
                                                                     F.lit(3))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return (df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
            .drop("__windows", "__sorted", "__starts"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts, the rates and ``base_failed``."""
    t = F.col("__text")
    df = docs.withColumn("__text", text_of(text)).withColumn("__words", words_of(t))
    df = _repeat_words(df)
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    df = df.select(
        "*", F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate(t, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("__lines")).drop("__words", "__text")
    df = df.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines")))
                       .cast("long"))

    def rate(a: str, b: Column) -> Column:
        return F.try_divide(F.col(a).cast("double"), b.cast("double"))

    n = F.col("n_words")
    return df.select(
        *[c for c in df.columns if c != "__lines"],
        rate("word_chars", n).alias("word_length"), rate("n_symbols", n).alias("symbol_rate"),
        rate("n_dup_lines", F.size("__lines")).alias("dup_line_rate"),
        rate("n_repeat_words", n).alias("repeat_rate"),
        ((n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n))
        .alias("base_failed"))


def thresholds(measured: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """One row per (lang, source) with documents that pass the base rule: lower
    and upper limit of each measure; the lower one is null where none holds."""
    aggs = [F.kll_sketch_agg_double(m, F.lit(config.sketch_k)).alias(m) for m in config.measures]
    groups = written(measured.where(~F.col("base_failed")).groupBy("lang", "source").agg(
        F.count("*").alias("__n"), *aggs), "quality-sketches")
    merged = groups.groupBy("lang").agg(
        *[F.kll_merge_agg_double(m).alias(f"__all_{m}") for m in config.measures])
    joined = lookup(groups, written(merged, "quality-language-sketches"), ["lang"])
    own = F.col("__n") / (F.col("__n") + config.half_weight)

    def quantile(m: str, at: float) -> Column:
        here, every = [F.kll_sketch_get_quantile_double(F.col(c), F.lit(at))
                       for c in (m, f"__all_{m}")]
        return own * here + (1 - own) * every

    limits = [F.col("lang"), F.col("source")]
    for m, tail in config.measures.items():
        mid, high, low = [quantile(m, at) for at in (0.5, tail.at, 1 - tail.at)]
        lower = low - tail.times * (mid - low) if tail.both else F.lit(None).cast("double")
        limits += [mid.alias(f"__mid_{m}"), lower.alias(f"__low_{m}"),
                   (high + tail.times * (high - mid)).alias(f"__high_{m}")]
    limits = written(joined.select(*limits), "quality-source-limits")

    def over_sources(name: str, at: float) -> Column:
        return F.percentile_approx(name, at).alias(f"__s{name}")

    holds = limits.groupBy("lang").agg(*[over_sources(f"__{e}_{m}", at) for m in config.measures
                                         for e, at in (("mid", 0.5), ("low", 1 - config.sources),
                                                       ("high", config.sources))])
    held = lookup(limits, written(holds, "quality-holds"), ["lang"])
    out = [F.col("lang"), F.col("source")]
    for m in config.measures:
        mid, low, high = [F.col(f"__s__{e}_{m}") for e in ("mid", "low", "high")]
        out += [F.when(low.isNotNull(), F.greatest(f"__low_{m}", mid - config.widen * (mid - low)))
                .alias(f"__low_{m}"),
                F.least(f"__high_{m}", mid + config.widen * (high - mid)).alias(f"__high_{m}")]
    return held.select(*out)


def judge(measured: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """Adds ``kept``: false where the base rule fails or a measure lies outside
    the limits of the document's language and source."""
    limits = written(thresholds(measured, config), "quality-limits")
    ok = ~F.col("base_failed")
    for m in config.measures:
        within = (F.col(m) <= F.col(f"__high_{m}")) & F.coalesce(
            F.col(m) >= F.col(f"__low_{m}"), F.lit(True))
        ok = ok & F.coalesce(within, F.lit(False))
    df = lookup(measured, limits, ["lang", "source"]).withColumn("kept", ok)
    return df.drop(*[f"__{e}_{m}" for m in config.measures for e in ("low", "high")])


def quality_rules(docs: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, text, lang, source)."""
    narrow = measure(docs.select("doc_id", "text", "lang", "source")).drop("text")
    return judge(written(narrow, "quality-measures"), config)


def keep_good(docs: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were, whatever
    further columns there are."""
    packed = docs.select(F.struct("*").alias("__row"), "text", "lang", "source")
    measured = written(measure(packed).drop("text"), "quality-rows")
    return judge(measured, config).where("kept").select("__row.*")
