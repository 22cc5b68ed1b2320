import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("ids", T.StringType())])

LONG = " ".join(f"word{k % 997}x{k % 13}" for k in range(60_000))
PROSE = " ".join(f"term{k}" for k in range(80))


def edge_rows():
    """Nulls, empty and blank texts, a very long one, ties and repeated rows;
    columns whose names the operators use themselves."""
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "alone"), (5, LONG), (6, PROSE), (7, PROSE),
             (7, PROSE), (None, PROSE), (8, PROSE + " more"), (9, "a▁b <|endoftext|> é\U0001f600")]
    return [(i, t, None if i == 4 else "en", None if i == 6 else "s", None, "x", "y", "z")
            for i, t in texts]


@pytest.fixture(scope="session")
def edge(spark):
    from trendlens.session import prepare
    return prepare(spark).createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    from trendlens.session import prepare
    return prepare(spark).read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
