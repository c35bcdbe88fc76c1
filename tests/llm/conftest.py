import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = "some words of a very long text, é1 " * 3_000 + "x" * 30_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, equal texts and columns with clashing names."""
    rows = [
        (1, "a short text of six words", "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (4, LONG, "en", "s", 2),
        (5, "a short text of six words", "en", "s", 1), (6, "a short text of six words", "en", "s", 1), (6, "a short text of six words", "en", "s", 1),
        (None, "nobody's row", "en", "s", 1), (7, " \t\n", "de", "s", 3), (8, "<|endoftext|> Grüße, İstanbul und ǅ 漢字 é x's 12345", "de", "s", 3),
        (9, "one", "en", "s", 1), (10, "two words", "en", "s", 1), (11, "a b\x1cc\x0bd e \U0001f600", "en", "s", 1),
    ]
    wide = [(*r, 0, "x", 1.5, "h", "y") for r in rows]
    return spark.createDataFrame(
        wide, "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, score double, fingerprint string, token_ids string"
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
