from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, sid string, `n` string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns whose names the operators use inside."""
    long_ = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 1, 0.1, "x", "y", "z"),
        (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 1, 0.1, "x", "y", "z"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", None, "a", None, None, None, None, None),
        (3, None, "en", None, 1, None, None, None, None), (4, "", "fr", "b", 0, None, None, None, None), (5, " \t\n", None, "b", 3, None, None, None, None),
        (6, long_, "en", "c", len(long_), None, None, None, None), (7, "…, é 12 <|endoftext|> A.", "fr", "c", 5, None, None, None, None),
        (None, "no id here at all", "en", "b", 1, None, None, None, None), (8, "1234 !!", "de", "b", 1, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
