"""Every registered query against its SQL twin."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from quillstat.checks.queries import registered

QUERIES = registered()
ORACLE = {name: text for name, text in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in ("customer", "orders", "lineitem", "events", "part", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in places) for row in result.fetchall())
    got = Counter(tuple(row) for row in df.select(*columns).collect())
    assert got == want
    assert sum(got.values()) > 0


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_in_the_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_age_reads_only_what_it_needs(spark, sf_dir):
    """The publication dates come without the joins that fill the other columns."""
    plan = QUERIES["publication_fact"](spark, sf_dir).select(
        "publication_id", "publication_date"
    ).distinct()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
