"""Connected components of a link table by least labels, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node
    that can be reached.  Each round takes the least label among neighbours and
    then follows labels to their own label, so chains shorten quickly; a round
    is written to the shared folder before the next one reads it.  Rounds end
    when no label changes."""
    both = written(links.select("a", "b").union(links.select("b", "a"))
                   .where(F.col("a") != F.col("b")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(
            F.col("a").alias("__a")).agg(F.min("label").alias("__near"))
        step = labels.join(near, labels["node"] == near["__a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "__near").alias("label"))
        step = written(step, "labels-near")
        roots = step.select(F.col("node").alias("__root"), F.col("label").alias("__up"))
        step = written(step.join(roots, step["label"] == roots["__root"], "left").select(
            "node", "old", F.least("label", "__up").alias("label")), "labels")
        changed = step.where(F.col("old") != F.col("label")).limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
