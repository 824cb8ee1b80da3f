import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use themselves
        T.StructField("kept", T.StringType()),
        T.StructField("node", T.LongType()),
        T.StructField("_text", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) rows, with extra columns of
    clashing names."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang = (*r, "en")[:3]
            full.append((doc_id, text, lang, "s", len(text or ""), "x", 7, "y", 0.5))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, a long text."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (None, "a text without an id"),
        (None, None),
        (5, "one two"),
        (5, "one two"),
        (6, "one two"),
        (7, long_text),
        (8, long_text + " tail"),
    ]
