"""The registry loads with no Spark session and no jar."""

import subprocess
import sys

from tests.conftest import ROOT

CODE = """
import glob, zipfile
def refuse(*a, **b):
    raise FileNotFoundError("no jar here")
glob.glob = refuse
zipfile.ZipFile = refuse
import __spark_entry__ as E
assert len(E.queries()) >= len(E.oracle_sql()) > 60
assert "/*stop words*/" not in "".join(E.oracle_sql().values())
"""


def test_registry_loads_without_jars_or_session():
    r = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True)
    assert r.returncode == 0, r.stderr


def test_stop_words_equal_those_spark_serves(spark):
    from pyspark.ml.feature import StopWordsRemover
    from trendlens.functions.stopwords import DEFAULT_LANGUAGES, load_language
    for lang in DEFAULT_LANGUAGES:
        assert list(load_language(lang)) == StopWordsRemover.loadDefaultStopWords(lang)


def test_cluster_needs_a_shared_checkpoint_folder():
    import pytest
    from trendlens.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
