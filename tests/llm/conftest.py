from __future__ import annotations

import pytest

EXTRA = "size long, score double, rank int, shard int, print long, severity double, ids string, row string, value string"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows as a documents table, with extra columns whose names operators use themselves."""

    def make(rows):
        rows = [(*row, 1, 0.5, 2, 3, 4, 0.1, "x", "y", "z") for row in rows]
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 3), (None, "a null key with some words", "en", "a", 5),
        (None, None, None, None, None), (4, long, "en", "a", 9), (5, "one", "en", None, 3), (6, "same text here twice", "en", "b", 1),
        (7, "same text here twice", "en", "b", 1), (7, "same text here twice", "en", "b", 1), (8, "é" * 3000, "fr", "b", 1),
        (9, "<|endoftext|> <b> \\ ''   😀", None, "c", 1),
    ]
    return documents(rows)
