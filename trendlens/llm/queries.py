"""The registered ``opN_*`` queries: each applies its operator to a whole table
and keeps the columns of the query's contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.llm import archive, brown_model, burst_trie
from trendlens.llm import fingerprint as fp
from trendlens.llm import near_duplicates as near
from trendlens.llm import packing, prefix_tokens
from trendlens.llm import piece_transducer as transducer
from trendlens.llm import quality_classifier as classifier
from trendlens.llm import quality_rules as quality
from trendlens.llm import spelling_variants as spelling
from trendlens.llm import sql
from trendlens.llm import toxicity as tox
from trendlens.llm import voronoi_search as search
from trendlens.plans.registry import register, table

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_class_scores")
def op1_class_scores(spark, sf_dir):
    return brown_model.class_scores(table(spark, sf_dir, "documents"))


@register("op2_archive", sql.ARCHIVE)
def op2_archive(spark, sf_dir):
    return archive.archived(table(spark, sf_dir, "pages"))


@register("op3_near_duplicates", sql.NEAR_DUPLICATES)
def op3_near_duplicates(spark, sf_dir):
    return near.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@register("op4_sentencepiece")
def op4_sentencepiece(spark, sf_dir):
    return transducer.round_trip(table(spark, sf_dir, "documents"), tokenizer(PIECE_BPE))


@register("op5_packing")
def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


@register("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    out = tox.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_sentences",
                      F.size("offending").cast("long").alias("n_offending"))


@register("op8_quality_rules", sql.QUALITY_RULES)
def op8_quality_rules(spark, sf_dir):
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


@register("op9_fingerprint", sql.FINGERPRINT)
def op9_fingerprint(spark, sf_dir):
    return fp.neighbour_fingerprints(table(spark, sf_dir, "documents"))


@register("op10_quality_classifier")
def op10_quality_classifier(spark, sf_dir):
    out = classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@register("op11_spelling_variants", sql.SPELLING_VARIANTS)
def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@register("op12_conversation_trie", sql.CONVERSATION_TRIE)
def op12_conversation_trie(spark, sf_dir):
    return burst_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@register("op13_vector_search", sql.VECTOR_SEARCH)
def op13_vector_search(spark, sf_dir):
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
