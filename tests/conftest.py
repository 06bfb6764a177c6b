from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillstat import build_session  # noqa: E402
from quillstat.schemas import RAW, struct  # noqa: E402
from quillstat.sources.tables import Sources  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        4,
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": folder,
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def raw(spark):
    """Make a raw table from rows given as dicts; missing columns are NULL."""

    def make(name: str, *rows: dict):
        schema = struct(RAW[name])
        unknown = {c for row in rows for c in row} - set(schema.names)
        assert not unknown, unknown
        return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)

    return make


@pytest.fixture
def sources(raw):
    """All raw tables, empty unless rows are given by table name."""

    def make(**tables):
        return Sources(
            {n: (lambda n=n: raw(n, *tables.get(n, []))) for n in RAW}
        )

    return make


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """Sorted tuples of the chosen columns, for comparing without an order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
