"""Small tables with the cases every operator has to bear."""

import pytest

ODD = [
    (1, "plain words in a short text", "en"), (2, None, "en"), (3, "", None), (4, "naïve café — 日本語 🙂", "fr"),
    (5, "plain words in a short text", "en"), (None, "a row without an id", None), (7, "long " * 20_000, "en"), (8, "x" * 30_000, "de"),
    (8, "x" * 30_000, "de"), (9, " \n\t   ", "es"), (10, "tail\n\nlines\nplain words in a short text", "en"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, lang, "s", len(t or ""), "x", 1, "y") for i, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, size int, h string").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
