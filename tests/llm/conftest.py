import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or longer rows."""

    def build(rows):
        full = [(*r, *(None, None, None)[len(r) - 2 :])[:5] for r in rows]
        return spark.createDataFrame([(a, b, c, d, len(b) if b is not None else None) for a, b, c, d, _ in full], DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, very long, repeated and id-less rows."""
    long_text = " ".join(f"w{i % 977} x{i % 31}" for i in range(20_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long_text, "en", "a"), (5, long_text, "en", "a"), (None, "no id here", None, "b"), (6, "É ß 漢字 \x00 end")]


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
