from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns of names that operators use inside."""
    long = " ".join(f"w{i % 977}x" for i in range(30_000))
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "some words here and there", "de", "b", 25),
            (4, long, "en", "a", len(long)), (5, "same text twice", "en", "c", 15), (5, "same text twice", "en", "c", 15),
            (6, " \t\n ", "fr", "b", 4), (7, "é" * 50, None, None, 50), (None, None, None, None, None)]
    rows = [(*r, i, "x", 1.5, 2, "y") for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "row bigint, _id string, score double, _nth int, label string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (5, 0, 1), (5, 1, 0), (None, 1, 1), (7, None, None)],
                                 "doc_id bigint, quality int, toxic int")
