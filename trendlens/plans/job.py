"""The three stages chained: preprocess -> train -> infer."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from trendlens.plans.config import JobConfig
from trendlens.plans.infer import infer
from trendlens.plans.preprocess import preprocess
from trendlens.plans.train import train


def run(spark: SparkSession, input_dir: str, output_dir: str, cfg: JobConfig | None = None):
    cfg = cfg or JobConfig()
    pre = preprocess(spark, input_dir, os.path.join(output_dir, "processed"), cfg)
    trained = train(pre, os.path.join(output_dir, "train"), cfg)
    return pre, trained, infer(pre, trained, os.path.join(output_dir, "infer"), cfg)
