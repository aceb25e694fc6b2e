import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd import PASSAGE, SF  # noqa: E402

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, lang, source) of the small table."""
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text[, source[, lang]])."""
        full = []
        for row in rows:
            doc_id, text, source, lang = (*row, *("s", "en")[len(row) - 2 :])[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, text without spaces."""
    return [
        (1, None, "a", "en"), (2, "", "a", "en"), (3, "   \n\t ", None, None), (4, "one", "b", "de"),
        (5, PASSAGE, "b", "en"), (6, PASSAGE, "b", "en"), (7, PASSAGE.upper(), "c", None), (8, PASSAGE + " more", None, "en"),
        (9, "x" * 200_000, "hot", "en"), (10, "é" * 3000 + " " + PASSAGE, "hot", "fr"), (11, "a b c d", "hot", "en"),
        (12, "A B C D", "hot", "en"), (13, "    日本語のテキスト", "d", "ja"), (14, "12 34 56 !!", "d", None),
        *((20 + i, "the same short text again and again", "hot", "en") for i in range(30)),
        *((60 + i, "filler " * 20 + f"row {i} " + PASSAGE[i * 7 : i * 7 + 900], "hot", "en") for i in range(12)),
    ]
