from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def documents(spark):
    """A function from (doc_id, text) rows to a table like documents."""

    def make(rows):
        rows = [(i, t, "en", "s", None) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def corpus(spark, folder):
    """The documents of the smallest tables, as rows."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
