from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with names used inside."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
    rows = [
        (None, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, " \t\n ", "en", "a", 4),
        (3, "one two three", "en", "b", 13),
        (3, "one two three", "en", "b", 13),
        (4, "one two three", "de", None, 13),
        (None, "one two three", "de", None, 13),
        (5, long_text, "fr", "b", len(long_text)),
        (6, "é è ü " * 30, "fr", "c", 180),
        (7, "aucun\u00a0mot joint\u2003ici", None, "c", 20),
    ]
    rows = [(*row, f"r{i}", i, i, i, True) for i, row in enumerate(rows)]
    return spark.createDataFrame(rows, f"{DOCS}, row string, size long, key long, target long, kept boolean")
