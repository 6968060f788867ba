import pytest
from pyspark.sql import types as T

FIELDS = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
# names that the operators use for columns of their own
CLASHES = ["size", "key", "bucket", "order", "fp", "in", "pos", "site", "first", "held", "block", "copies", "shard", "n_tokens", "taken", "part", "component",
           "row", "text_key", "gone", "gone_id", "gone_key", "lines", "removed", "nth", "least", "copy", "doc", "id", "fps", "pos_at", "grp", "digest", "gram", "class", "n", "grams",
           "__fp", "__kept", "__least", "__gone", "__lines", "__removed", "__id", "__key", "__copies", "__text", "__copy"]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in FIELDS] + [T.StructField(n, T.StringType()) for n in CLASHES])


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, further columns."""
    prose = "the quick brown fox jumps over the lazy dog and then runs home to sleep again until morning comes around"
    long = " ".join(f"word{i % 977} of" for i in range(60_000))
    rows = [
        (1, prose, "en", "a", 5), (1, prose, "en", "a", 5),  # a repeated row
        (2, prose, "en", None, None), (None, prose, None, "b", 1), (None, None, None, None, None),
        (3, "", "en", "a", 0), (4, " \n\t ", "de", "b", 4), (5, None, "en", "c", None), (6, long, "en", "a", len(long)),
        (7, "one", "xx", "b", 3), (8, "same line here\n" + prose, "en", "a", 1), (9, "same line here\nother text", "en", "b", 1),
        (10, "same line here\n\nthird", "en", "c", 1), (11, "same line here", "en", "d", 1), (12, "same line here", "en", "e", 1), (12, "same line here", "en", "e", 1),
    ]
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
