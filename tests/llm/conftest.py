import os

import pytest

FIXTURE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(FIXTURE):
        pytest.skip("no fixture tables")
    return FIXTURE


DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, `key` string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog today", "en", "a", 1, 9, 0.5, "k"),
        (1, "The quick brown fox jumps over the lazy dog today", "en", "a", 1, 9, 0.5, "k"),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "b", 0, 0, 0.0, ""),
        (4, " \t\n", "en", "b", 3, 1, 0.0, ""),
        (5, long, "en", "b", len(long), 1, 0.0, "z"),
        (None, "no id here", "fr", "c", 4, 2, 1.0, "q"),
        (6, "one two", "de", None, 7, 2, 1.0, "q"),
        (7, "Ünïcode ção — 一二三 😀 <b>&amp;</b>", "es", "c", 9, 2, 1.0, "q"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
