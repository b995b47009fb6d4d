"""Fixtures and paths that these tests share."""

import pytest

SF_SMALL, SF, SF_TENTH = (f"/root/testdata/{d}" for d in ("sf0.001", "sf0.01", "sf0.1"))

LONG = "word " * 5000 + "end"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long, token string, n long"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls, empty and long texts, repeated rows, and columns named as operators name theirs."""
    rows = [
        (1, None, None, None, None, "x", 1),
        (2, "", "en", "a", 0, None, 2),
        (3, " \n\t ", "en", "a", 4, "x", None),
        (4, LONG, "en", "b", len(LONG), "x", 1),
        (4, LONG, "en", "b", len(LONG), "x", 1),
        (None, "a lone text without an id", "en", None, 25, "x", 1),
        (5, "short", None, "b", 5, "x", 1),
        (6, "Ünïcode 漢字 text <|endoftext|> 12", "fr", "c", 33, "x", 1),
        (7, "12 34 !?", "fr", "c", 8, "x", 1),
    ]
    return spark.createDataFrame(rows, docs_schema)


@pytest.fixture(scope="session")
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)
