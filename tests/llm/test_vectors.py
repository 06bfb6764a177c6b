"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.llm import queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, weight string, tile string"
EXTRA = ("x", "y", "z")


def brute(rows, threshold=0.98):
    """(id, links, component, kept) of every row, by all pairs."""

    def sound(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    known = [i for i, (_, v, label) in enumerate(rows) if sound(v, label)]
    unit = {i: np.float32(rows[i][1]).astype(float) for i in known}
    near = {i: set() for i in range(len(rows))}
    for a in known:
        for b in known:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                x, y = unit[a], unit[b]
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for i, (own, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((own, len(near[i]), least, own == least))
    return sorted(out, key=repr)


def found(df, **more):
    return sorted((tuple(r) for r in vectors.link(df, **more).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def clouds(seed, groups, each, length, spread):
    """Vectors around some centres, with labels from a few, and exact copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=length)
        for _ in range(each):
            v = centre + spread * np.linalg.norm(centre) / np.sqrt(length) * rng.normal(size=length)
            rows.append((len(rows) + 1, [float(x) for x in np.float32(v)], g % 3))
    return rows + [(len(rows) + 1 + i, v, label) for i, (_, v, label) in enumerate(rows[::7])]


def edge_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (1, [1.0, 0.0, 0.0], 0),
        (2, [2.0, 0.0, 0.0], 0),  # another length, the same direction
        (3, [1.0, 0.0, 0.0], 1),  # another label
        (4, [1.0, 0.0, 0.0], None),
        (5, None, 0),
        (6, [], 0),
        (7, [0.0, 0.0, 0.0], 0),
        (8, [0.0, 0.0, 0.0], 0),
        (9, [1.0, None, 0.0], 0),
        (10, [1.0, nan, 0.0], 0),
        (11, [1.0, inf, 0.0], 0),
        (12, [1.0, 0.0, 0.0, 0.0], 0),  # another dimension
        (13, [3e38, 1e30, 0.0], 0),  # squares leave the range of floats
        (14, [1e-38, 0.0, -0.0], 0),
        (2, [0.0, 1.0, 0.0], 0),  # a repeated id
        (None, [0.0, 1.0, 0.0], 0),
        (None, [0.0, 0.0, 1.0], 0),
        (None, [0.0, 0.0, 1.0], 0),
        (15, [-1.0, 0.0, 0.0], 0),
        (16, [5.0], 2),
        (17, [7.0], 2),
        (18, [-7.0], 2),
    ]


def test_edges(spark):
    df = table(spark, edge_rows())
    assert found(df) == brute(edge_rows())
    assert found(df.limit(0)) == []


@pytest.mark.parametrize("tile", [(256, 2048), (3, 5)], ids=["one tile", "many tiles"])
@pytest.mark.parametrize("spread", [0.05, 0.13, 0.2])
def test_clouds(spark, monkeypatch, tile, spread):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(vectors, "STRIP", 2)
    rows = clouds(int(spread * 100), 6, 12, 24, spread)
    assert found(table(spark, rows)) == brute(rows)


def test_other_thresholds_and_types(spark):
    rows = clouds(5, 4, 8, 9, 0.4)
    df = table(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    df = df.withColumn("label", F.col("label").cast("string"))
    for threshold in (0.5, 0.9, 1 - 1e-9):
        assert found(df, threshold=threshold) == brute(rows, threshold)


def test_pairs_at_the_threshold(spark):
    """Angles on either side of the threshold, nearer than any rounding of the products."""
    right = math.acos(0.98)
    rows = [(1, [1.0, 0.0], 0)]
    for i, step in enumerate((-1e-6, -1e-9, 1e-9, 1e-6)):
        rows.append((2 + i, [math.cos(right + step), math.sin(right + step)], 0))
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA.replace("float", "double"))

    links = {r.vec_id: r.n_links for r in vectors.link(df).collect()}
    assert links == {1: 2, 2: 4, 3: 4, 4: 3, 5: 3}


def test_roots_and_bounds():
    assert list(vectors.roots(6, np.array([4, 2, 5]), np.array([2, 1, 5]))) == [0, 1, 1, 3, 1, 5]
    assert vectors.steps_of(24) == [8, 16, 24] and vectors.steps_of(3) == [3]
    rows = np.random.default_rng(1).normal(size=(4, 24))
    norms = vectors.suffix_norms(rows, [8, 24])
    assert np.allclose(norms[:, 0], np.linalg.norm(rows[:, 8:], axis=1)) and not norms[:, 1].any()


def test_a_group_of_copies_costs_no_products(spark):
    """Thousands of rows of one vector are one node."""
    df = spark.range(5000).select(
        F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"), F.lit(1).alias("label")
    )
    out = vectors.link(df)
    assert out.groupBy("n_links", "component_id").count().collect() == [(4999, 0, 5000)]


def test_the_query_finds_links_in_larger_tables(spark, tmp_path):
    rows = clouds(8, 9, 20, 64, 0.1)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries.op11_vectors(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute(rows)
