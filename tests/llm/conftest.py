import pytest
from pyspark.sql import types as T

LONG = "una palabra larga con tilde é y 1.2.3.4 " * 60_000 + "fin a@b.co"

ROWS = [
    (1, "Hello world, this is one plain text of several words. Mail me: a.b@example.com now.", "en", "s0"),
    (2, "Hello world, this is one plain text of several words. Mail me: a.b@example.com now.", "en", "s1"),
    (2, "Hello world, this is one plain text of several words. Mail me: a.b@example.com now.", "en", "s1"),
    (3, None, None, None),
    (4, "", "de", "s0"),
    (5, "   \t\n ", None, "s1"),
    (None, "text without an id", "en", None),
    (7, "Licensed under the MIT License. ¿Qué? 漢字", "es", "s0"),
    (8, "!!! ... ###", "en", "s0"),
    (9, "one two", "en", "s0"),
    (10, "one\ttwo", "en", "s2"),
    (11, LONG, "es", "s0"),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns that clash with inner names."""
    clash = ["id", "key", "bin", "rate", "n", "_n", "_row", "_sha", "start", "part", "band", "bucket", "tree", "size", "_gone"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in clash])
    return spark.createDataFrame([r + ("x",) * (len(clash) - 1) + (None,) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
