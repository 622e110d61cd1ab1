import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text)."""

    def make(*rows, lang="en"):
        full = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, lang, "src", None if t is None else len(t)) for i, t in full], DOCS)

    return make


@pytest.fixture
def odd_docs(docs):
    """Null and empty texts, null ids, repeated rows, ties, a long text, and clashing columns."""
    from pyspark.sql import functions as F

    long = "tall words stand in a row and go on " * 8000
    frame = docs((1, None), (2, ""), (3, ""), (None, "lost words here"), (None, None), (4, "same row"), (4, "same row"), (5, "same  row"), (6, long), (7, "one\ntwo"))
    for name in ("s", "fp", "digest", "winner", "kept", "copy", "_lang", "language_id", "copies", "_id", "block", "part", "lines", "ghost", "id", "key", "group"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
