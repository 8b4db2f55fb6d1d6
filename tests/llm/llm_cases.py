"""Documents with every odd case, shared by the tests of this folder."""

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} of the year {i % 31}" for i in range(12_000))
#: Columns whose names the operators use inside.
CLASHES = ["id", "h", "sha", "word", "row", "ids", "shard", "fp", "rep", "mask", "line", "lines", "base", "spans", "_row", "candidate", "component", "node", "kind", "block"]


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with nulls in any column, empty, blank, very long and repeated texts, repeated rows and clashing columns."""
    from pyspark.sql import functions as F
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n\t ", None, "a", 6), (4, LONG, "en", None, len(LONG)),
        (5, "Hello World from here", "en", "a", 21), (6, "Hello World from here", "en", "b", 21), (6, "Hello World from here", "en", "b", 21),
        (7, "hello WORLD from here", "en", "b", 21), (8, "12345 !!! 999", "en", "b", 13), (9, "Ünïcode ßtraße 😀 naïve é", "de", "c", 20),
        (None, "a text without an id", "en", "c", 20), (None, None, None, None, None), (10, "x", "fr", "c", 1), (11, "a b", "fr", "c", 3),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
