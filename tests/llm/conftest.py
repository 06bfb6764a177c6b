from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tables_of_texts import CLASHING, SCHEMA, edge_texts  # noqa: E402

from quillstat.llm import chunks  # noqa: E402


@pytest.fixture
def table(spark):
    """Documents from (id, text) pairs; language and source repeat, with nulls."""

    def make(pairs):
        langs, sources = ("en", "fr", None), ("b", "a", None, "é", "b", "b")
        rows = [
            (i, t, langs[k % 3], sources[k % 6], len(t or ""), *["other"] * len(CLASHING))
            for k, (i, t) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def edges(table):
    return table(edge_texts())


@pytest.fixture
def empty(table):
    return table([])


@pytest.fixture(params=[4_000_000, 2_000], ids=["one chunk", "many chunks"])
def chunk_size(request, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", request.param)
