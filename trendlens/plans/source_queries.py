"""Registered source / sink round trips (survey S2, S7, S8, S10).  Each one
writes a table derived from the driver tables into the shared scratch
folder, reads it back through the library's reader, and must return the
original rows."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.plans import feature_queries as FQ
from trendlens.plans.registry import ORACLE, register, table
from trendlens.session import scratch_path
from trendlens.sources import sinks
from trendlens.sources.videos import file_encodings


@register("roundtrip_csv", "SELECT doc_id, lang, text FROM documents")
def roundtrip_csv(spark, sf_dir):
    """Quoted multi-line CSV written and read back unchanged."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = sinks.write_csv(d, scratch_path(spark, "docs_csv"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("lang", T.StringType()),
                           T.StructField("text", T.StringType())])
    return sinks.read_csv(spark, path, schema)


@register("encoding_detect", "SELECT doc_id, lang, text FROM documents")
def encoding_detect(spark, sf_dir):
    """Folders by language, French written as ISO-8859-1; every file
    is classified by UTF-8 validity and read with its own encoding."""
    base = scratch_path(spark, "enc")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for enc, of in (("ISO-8859-1", F.col("lang") == "fr"), ("UTF-8", F.col("lang") != "fr")):
        (d.filter(of).withColumn("part", F.col("lang")).write.partitionBy("part")
         .option("header", True).option("escape", '"').option("encoding", enc)
         .csv(os.path.join(base, enc)))
    files = file_encodings(spark, base, "*/*/*.csv").select("path", "utf8").collect()
    schema = "doc_id long, lang string, text string"
    parts = []
    for utf8, enc in ((True, "UTF-8"), (False, "ISO-8859-1")):
        paths = [r["path"] for r in files if r["utf8"] == utf8]
        if paths:
            parts.append(spark.read.schema(schema).option("header", True)
                         .option("multiLine", True).option("escape", '"')
                         .option("encoding", enc).csv(paths))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("roundtrip_stage", ORACLE["stratified_split"])
def roundtrip_stage(spark, sf_dir):
    """Split table written as Parquet partitioned by split, read back."""
    df = FQ.stratified_split(spark, sf_dir)
    path = sinks.write_stage(df, scratch_path(spark, "split"), partition_by=["split"])
    return sinks.read_stage(spark, path).select("doc_id", "quality", "toxic", "split")


@register("metrics_json", ORACLE["classification_report"])
def metrics_json(spark, sf_dir):
    """Metrics written as JSON lines and read back."""
    rep = FQ.classification_report(spark, sf_dir)
    path = sinks.write_metrics(rep, scratch_path(spark, "metrics"))
    schema = "label string, precision double, recall double, f1 double, support long"
    return spark.read.schema(schema).json(path)
