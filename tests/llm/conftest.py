from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, ids string, row long, spans int, node string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty and long texts, repeated rows and ids, columns named like the operators' own."""
    long_text = " ".join(f"word{i % 977} of the river" for i in range(20_000))
    texts = [
        (1, "the quick brown fox and the lazy dog walk to the old river"), (1, "the quick brown fox and the lazy dog walk to the old river"),
        (1, "another text under the same id with some words"), (2, None), (3, ""), (4, " \t\n "), (None, "a text without an id is here"),
        (None, None), (5, long_text), (6, long_text), (7, "12 34"), (8, "ß é 日本語 😀"), (9, "a"), (10, "x" * 50_000),
    ]
    rows = [(i, t, "en" if k % 3 else None, None, len(t or ""), "s", "i", k, k, "n") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
