"""Every registered query with oracle SQL must equal DuckDB on the same tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck_connect

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con)
    assert r["status"] == "exact", r


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["lang", "n_docs", "n_words", "avg_length", "n_labelled", "n_toxic"]
