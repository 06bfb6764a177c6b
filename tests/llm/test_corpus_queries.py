"""The registered corpus queries against their SQL twins, and the pipeline by stages."""

from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from tables_of_texts import edge_texts

from quillstat.llm import decontamination, langid, minhash, mixing, queries, sharding

QUERIES = queries.registered()
ORACLE = queries.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_one_query_for_each_operator():
    names = [n.split("_")[0] for n in QUERIES]
    assert names == [f"op{n}" for n in range(1, 14)] + ["pipeline"]
    assert set(ORACLE) < set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_twin(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in places) for row in result.fetchall())
    assert Counter(tuple(row) for row in df.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"pipeline"}))
def test_every_document_once(spark, duck, sf_dir, name):
    found = [r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()]
    known = [i for (i,) in duck.execute("SELECT doc_id FROM documents").fetchall()]
    if name.startswith("op1_"):
        assert set(found) <= set(known)
    else:
        assert sorted(found) == sorted(known)


def test_held_out_accuracy(spark, duck, sf_dir):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in QUERIES["op9_langid"](spark, sf_dir).collect() if r.held_out]
    right = sum(r.lang_pred == langs[r.doc_id] for r in held)
    assert right >= 0.95 * len(held) > 0
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in QUERIES["op7_quality"](spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.85 * len(held) > 0


# Pipeline


@pytest.fixture
def folder(spark, tmp_path):
    items = [(1, "a test item of some words that no other text holds in this order")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def leaked():
    return [(900, "before it " + "a test item of some words that no other text holds in this order")]


def test_stages_keep_the_columns(spark, table, folder):
    docs = table(edge_texts() + leaked())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.names == docs.schema.names, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert set(out.columns) == set(docs.columns) | {"shard", "slot"}


def test_decisions_take_effect(spark, table, folder):
    pairs = edge_texts() + leaked()
    docs = table(pairs)
    docs.write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).collect()

    known = {r.text for r in langid.keep_known(docs).collect()}
    assert "12345 !!! ???" not in known and "" not in known
    spoken = table([p for p in pairs if p[1] in known])
    links = minhash.link(spoken).collect()
    firsts = {r.doc_id for r in links if r.kept}
    assert {r.doc_id for r in out} <= firsts - {900}
    assert 900 in firsts  # only the third stage drops it
    assert all(n <= mixing.MAX_EPOCHS for n in Counter((r.doc_id, r.text) for r in out).values())
    slots = Counter((r.shard, r.slot) for r in out)
    assert set(slots.values()) == {1}
    assert all(0 <= r.shard < sharding.SHARDS for r in out)
    assert decontamination.find(
        table([(r.doc_id, r.text) for r in out]), spark.read.parquet(f"{folder}/benchmark.parquet")
    ).isEmpty()


def test_the_rest_imports_without_the_operators(tmp_path):
    """The entry point leaves the corpus queries out if, and only if, they are missing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "quillstat", ".git"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "quillstat")
    for name in os.listdir(f"{root}/quillstat"):
        if name != "llm":
            os.symlink(f"{root}/quillstat/{name}", tmp_path / "quillstat" / name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'user_analysis' in q; print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) >= 30
