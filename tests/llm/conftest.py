from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text) of the smallest table, as Python rows."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def odd_rows():
    """Rows that any text operator must take: null, empty, blank, repeated, long, astral characters, null id."""
    long = "word " * 30_000 + "end"
    return [(1, None), (2, ""), (3, " \t\n "), (4, "a b"), (4, "a b"), (5, long), (6, "𝒳 é 😀 ſecret=abcdefgh12"), (None, "no id"), (7, "x")]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
