import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source) rows, over several partitions."""

    def make(rows, parts=3):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows and a very long text."""
    words = " ".join(f"word{i % 977} other{i % 31}" for i in range(20_000))
    return [
        (1, "alpha beta gamma delta epsilon zeta", "en", "s1"),
        (2, "alpha beta gamma delta epsilon zeta", "en", "s1"),
        (2, "alpha beta gamma delta epsilon zeta", "en", "s1"),
        (3, None, None, None),
        (4, "", "en", "s1"),
        (5, " \t\n ", "en", None),
        (None, "alpha beta gamma delta epsilon zeta", None, "s2"),
        (None, None, None, None),
        (6, words, "en", "s1"),
        (7, "Ünïcödé Wörter über ÄÖ", "de", "s2"),
        (8, "12345 67890", "en", "s2"),
    ]


@pytest.fixture(scope="session")
def clashing(make_docs, odd_rows):
    """The odd rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    docs = make_docs(odd_rows)
    for name in ("_id", "_text", "cls", "n", "kept", "score", "shard", "slot", "tokens", "block", "size", "part", "_len"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs
