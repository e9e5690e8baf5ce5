"""Rows that every operator must take."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and empty texts, ties, repeated rows, null ids, long texts and white space of all kinds.
EDGES = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t \x0b", "en", None, 5),
    (4, "one two three", None, "a", 13),
    (5, "one two three", "en", "b", 13),
    (5, "one two three", "en", "b", 13),
    (None, "Nobody knows this line\nNor this", "en", "b", 30),
    (7, "word " * 30_000, "en", "b", 150_000),
    (8, "é ü ñ 漢字 \U0001f600 x" * 9, "de", "b", 60),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(edges):
    """Columns named like the results, and like the ones used inside."""
    from pyspark.sql import functions as F

    names = ["kept", "n_words", "n_dropped", "n_lines", "slot", "in_mix", "row", "distance", "component_id", "block", "x"]
    return edges.withColumns({n: F.lit("mine") for n in names})
