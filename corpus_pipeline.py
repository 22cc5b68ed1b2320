"""The training-data pipeline over ``documents``: toxic documents go, documents
that fail the quality rules go, one document of each group of near-duplicates
stays, and the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next stage's documents.  All but the
last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlens.llm import near_duplicates, packing, quality_rules, toxicity
from trendlens.llm.common import written
from trendlens.llm.queries import BYTE_BPE, tokenizer
from trendlens.plans.registry import register, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def remove_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer(BYTE_BPE))


STAGES = [("toxicity", remove_toxic), ("quality rules", remove_poor),
          ("near-duplicates", remove_near_duplicates), ("packing", pack)]

#: A trained model and tokenisation have no SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name.replace(' ', '-')}")
    return docs


register("pipeline", ORACLE_SQL)(run)
