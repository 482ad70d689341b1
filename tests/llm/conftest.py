import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("fp", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("__m", T.StringType()),
        T.StructField("__rep", T.StringType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Makes documents of texts: a list of texts, or of (id, text) pairs; with columns of clashing names."""

    def make(texts, lang="en", source="s"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", "x", "x", "x", "x", "x") for i, t in rows], DOCS)

    return make


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "null id"), (5, "long " * 30000), (6, "Ünïcode 🙂 ΣΑΣ"), (7, "a b c d e f g h i j k l m n")]


@pytest.fixture
def odd(docs):
    return docs(ODD)
