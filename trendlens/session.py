"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "trendlens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster ``master`` stays ``None`` so spark-submit decides; local runs
    pass ``local[N]``.  Shuffle partitions default to Spark's own value unless
    given, AQE then coalesces or splits them at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The value comes from ``spark.checkpoint.dir`` (or a directory already set
    on the context).  Only a ``local`` master (tests) may leave both unset and
    gets a private folder; on a cluster that folder would be on one machine,
    so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        configured = tempfile.mkdtemp(prefix="trendlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Make ``trendlens`` importable in Python workers (pandas UDF kernels).

    Equivalent to ``spark-submit --py-files trendlens.zip``: the package is
    zipped once on the driver and added with ``addPyFile``; Spark serves it to
    every executor.  Idempotent per SparkContext.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_trendlens_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="trendlens-pyfiles-"), "trendlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith((".py", ".txt")):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    sc._trendlens_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Everything a query needs from the session: workers can import the
    package, and a checkpoint folder is set."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "trendlens", f"{name}-{uuid.uuid4().hex[:12]}")

