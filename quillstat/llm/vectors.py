"""Near-duplicate vectors by cosine: tiles of PCA coordinates, compared leading ones first.

1. Equal vectors of a label are one node with a weight, so copies cost nothing.
2. Vectors are scaled to length one and rotated to the principal axes of a sample, most
   spread first. A rotation leaves every cosine as it is, so a poor sample costs time only.
   Two unit vectors with a cosine of ``threshold`` are at most ``reach`` apart, and so are
   their leading coordinates.
3. Nodes are sorted by label and by cells, ``reach`` wide, of their leading coordinates, and
   cut into tiles of bounded size, none across two cells of the first two. Only tiles of
   neighbouring cells whose boxes come within ``reach`` are compared.
4. A tile is multiplied with another a few coordinates at a time. What the rest can add is
   at most the product of the suffix norms; a pair whose sum and bound stay below the
   threshold is given up. Tiles that lie wholly within reach are linked without products.
5. A tile pair returns, for each node, the weight it is linked with and the root of a
   spanning star, so no pair leaves a task. Stars give components by large-star and
   small-star.

The products decide with double precision; those within ``CLOSE`` of the threshold are done
again on the vectors as they came.

Defined results: a vector that is null, empty or zero, or holds a null, NaN or infinite
component, or has no label, is linked with nothing and is its own component. Vectors of
different length are not linked. Every row counts, also with a null or repeated id; the
component is named by its smallest id that is not null. No rows give no rows, other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.stars import components
from quillstat.llm.tables import cut, parts_for, with_library

THRESHOLD = 0.98
# The sample that the axes are fitted to: at most about so many numbers, of so many lengths.
FIT_VALUES = 1_000_000
FIT_LENGTHS = 4
# Leading coordinates that tiles have boxes of.
LEAD = 8
# Numbers in a tile, and the most and fewest rows of one.
TILE_VALUES = 131_072
TILE_ROWS = (256, 2048)
# Rows of a tile that are multiplied at once, and the share of pairs left below which the
# rest is done pair by pair.
STRIP = 256
SPARSE = 0.05
CLOSE = 1e-9
PART_BYTES = 16_000_000
LOT_BYTES = 16_000_000

CELLS = [f"cell_{i}" for i in range(LEAD)]
GROUP = ["label", "length", *CELLS[:2]]


def reach_of(threshold: float) -> float:
    """How far apart two unit vectors with this cosine are, with some slack for rounding."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    # The largest component is taken out first, so that no square leaves the range.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def axes_of(sample: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For the commonest lengths, the principal axes about the origin as columns."""
    by_length: dict[int, list[np.ndarray]] = {}
    for vector in sample:
        by_length.setdefault(len(vector), []).append(vector)
    axes = {}
    for length in sorted(by_length, key=lambda n: -len(by_length[n]))[:FIT_LENGTHS]:
        rows = unit(np.stack(by_length[length]))
        axes[length] = np.linalg.eigh(rows.T @ rows)[1][:, ::-1].copy()
    return axes


def rotated(rows: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    turn = axes.get(rows.shape[1])
    return unit(rows) if turn is None else unit(rows) @ turn


def steps_of(length: int) -> list[int]:
    """Where the sums are looked at: after 8, 16, 32, ... coordinates, and all."""
    return [n for n in (LEAD << i for i in range(20)) if n < length] + [length]


def suffix_norms(rows: np.ndarray, steps: list[int]) -> np.ndarray:
    """The norm of what follows each step, one column a step."""
    tail = np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]
    tail = np.concatenate([tail, np.zeros((len(rows), 1))], axis=1)
    return np.sqrt(tail[:, steps])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x, y = x.astype(np.float64), y.astype(np.float64)
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    dots, xx, yy = ((p * q).sum(axis=1) for p, q in ((x, y), (x, x), (y, y)))
    return dots / (np.sqrt(xx) * np.sqrt(yy))


def linked(
    a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (row of ``a``, row of ``b``) whose cosine reaches the threshold."""
    steps = steps_of(a.shape[1])
    norms_a, norms_b = suffix_norms(a, steps), suffix_norms(b, steps)
    found_u, found_v = [], []
    for top in range(0, len(a), STRIP):
        strip, norms = a[top : top + STRIP], norms_a[top : top + STRIP]
        sums, done, pairs = np.zeros((len(strip), len(b))), 0, None
        for at, step in enumerate(steps):
            if pairs is None:
                sums += strip[:, done:step] @ b[:, done:step].T
                alive = sums + np.outer(norms[:, at], norms_b[:, at]) >= threshold - CLOSE
                if step == steps[-1] or alive.mean() < SPARSE:
                    pairs = np.nonzero(alive)
                    sums = sums[pairs]
            else:
                u, v = pairs
                sums = sums + (strip[u, done:step] * b[v, done:step]).sum(axis=1)
                alive = sums + norms[u, at] * norms_b[v, at] >= threshold - CLOSE
                pairs, sums = (u[alive], v[alive]), sums[alive]
            done = step
        u, v = pairs
        close = np.flatnonzero(np.abs(sums - threshold) <= CLOSE)
        if len(close):
            right = np.ones(len(u), bool)
            right[close] = cosines(raw_a[top + u[close]], raw_b[v[close]]) >= threshold
            u, v = u[right], v[right]
        found_u.append(top + u)
        found_v.append(v)
    return np.concatenate(found_u), np.concatenate(found_v)


def all_linked(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two balls around the rows show that every pair is linked."""
    mid_a, mid_b = a.mean(axis=0), b.mean(axis=0)
    far = np.linalg.norm(mid_a - mid_b)
    far += max(np.linalg.norm(a - mid_a, axis=1)) + max(np.linalg.norm(b - mid_b, axis=1))
    return far <= reach_of(threshold) - 3e-6


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least place it is connected with."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], least)
        np.minimum.at(new, root[v], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def compared(own: pd.DataFrame, threshold: float, axes: dict[int, np.ndarray], kind: str) -> tuple:
    """Nodes of one or two tiles that are linked, the weight they are linked with, a root."""
    length = int(own["length"].iloc[0])
    raw = [np.frombuffer(d, kind).reshape(-1, length) for d in own["data"]]
    nodes = [np.frombuffer(d, np.int64) for d in own["nodes"]]
    weights = [np.frombuffer(d, np.int64) for d in own["weights"]]
    turned = [rotated(r, axes) for r in raw]
    a, b = turned[0], turned[-1]
    n, m = len(a), len(b)
    alone = len(own) == 1
    if all_linked(a, b, threshold):
        total = [np.full(n, weights[-1].sum()), np.full(m, weights[0].sum())]
        if alone:
            total[0] = total[0] - weights[0]
        root = np.zeros(n + (0 if alone else m), np.int64)
    else:
        u, v = linked(a, b, raw[0], raw[-1], threshold)
        if alone:
            u, v = u[u != v], v[u != v]
        total = [
            np.bincount(u, weights[-1][v], n).astype(np.int64),
            np.bincount(v, weights[0][u], m).astype(np.int64),
        ]
        root = roots(n, u, v) if alone else roots(n + m, u, v + n)
    ids = nodes[0] if alone else np.concatenate(nodes)
    links = total[0] if alone else np.concatenate(total)
    some = links > 0
    return ids[some], links[some], ids[root[some]]


def _placed(axes: dict[int, np.ndarray], cell: float, kind: str):
    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for length, own in pdf.groupby("length"):
                rows = np.stack(own["v"].to_numpy()).astype(kind)
                lead = np.zeros((len(rows), LEAD))
                lead[:, : int(length)] = rotated(rows, axes)[:, :LEAD]
                cells = np.floor(lead / cell).astype(np.int32)
                out = own[["node", "weight", "label", "length"]].copy()
                for i, name in enumerate(CELLS):
                    out[name] = cells[:, i]
                out["data"] = [r.tobytes() for r in rows]
                yield out

    return place


def _tiles(axes: dict[int, np.ndarray], kind: str):
    def tile_of(own: pd.DataFrame) -> tuple:
        first = own.iloc[0]
        data = b"".join(own["data"])
        turned = rotated(np.frombuffer(data, kind).reshape(len(own), -1), axes)[:, :LEAD]
        low, high = np.zeros(LEAD), np.zeros(LEAD)
        low[: turned.shape[1]], high[: turned.shape[1]] = turned.min(axis=0), turned.max(axis=0)
        nodes = own["node"].to_numpy(np.int64)
        return (
            *[int(first[c]) for c in ("node", "length", *CELLS[:2])], first["label"], low, high,
            data, nodes.tobytes(), own["weight"].to_numpy(np.int64).tobytes(),
        )

    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in parts:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            key = pdf[GROUP]
            run = (key != key.shift()).any(axis=1).cumsum().to_numpy()
            out, held = [], None
            for number, own in pdf.groupby(run):
                most = int(np.clip(TILE_VALUES // int(own["length"].iloc[0]), *TILE_ROWS))
                for at in range(0, len(own), most):
                    rows = own.iloc[at : at + most]
                    if number == run[-1] and len(rows) < most:
                        held = rows
                    else:
                        out.append(tile_of(rows))
            yield pd.DataFrame(out, columns=_TILE)
        if held is not None and len(held):
            yield pd.DataFrame([tile_of(held)], columns=_TILE)

    return build


_TILE = ["tile", "length", *CELLS[:2], "label", "low", "high", "data", "nodes", "weights"]


def _compare(threshold: float, axes: dict[int, np.ndarray], kind: str):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [compared(own, threshold, axes, kind) for _, own in pdf.groupby(["a", "b"])]
        node, links, root = (np.concatenate(c) for c in zip(*found, strict=True))
        return pd.DataFrame({"node": node, "links": links, "root": root})

    return compare


def _pairs(tiles: DataFrame, reach: float) -> DataFrame:
    """Pairs of tiles, each with itself too, that may hold vectors within reach."""


    def around(cell: str) -> Column:
        return F.explode(F.array(*[F.col(cell) + step for step in (-1, 0, 1)])).alias(cell)

    kept = [F.col("tile").alias("a"), "label", "length"]
    box = [F.col("low").alias("low_a"), F.col("high").alias("high_a")]
    a = tiles.select(*kept, *box, around(CELLS[0]), CELLS[1])
    a = a.select("a", "label", "length", "low_a", "high_a", CELLS[0], around(CELLS[1]))
    b = tiles.select(F.col("tile").alias("b"), *GROUP, "low", "high")
    gap = F.lit(0.0)
    for i in range(LEAD):
        apart = F.greatest(
            F.lit(0.0), F.col("low_a")[i] - F.col("high")[i], F.col("low")[i] - F.col("high_a")[i]
        )
        gap += apart * apart
    met = a.join(b, GROUP).filter((F.col("a") <= F.col("b")) & (gap <= reach * reach))
    return met.select("a", "b")


def _fit(classes: DataFrame, values: int, total: int) -> dict[int, np.ndarray]:
    share = min(1.0, FIT_VALUES / max(1, values))
    drawn = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    most = max(2, int(2 * total * share))
    sample = classes.filter(drawn).select("v").limit(most).toPandas()["v"]
    return axes_of([np.asarray(v, np.float64) for v in sample])


def link(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    with_library(spark)
    reach = reach_of(threshold)
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")
    )
    kind = "<f4" if rows.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    label_type = rows.schema["label"].dataType.simpleString()

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    sound = F.coalesce(
        F.col("label").isNotNull()
        & F.forall("v", finite)
        & F.exists("v", lambda x: F.coalesce(x != 0, F.lit(False))),
        F.lit(False),
    )
    sound_rows = rows.filter(sound)
    classes = cut(
        sound_rows.groupBy("label", "v")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("length", F.size("v")),
        "vectors-classes",
    )
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("values")).first()
    axes = _fit(classes, size["values"] or 0, size["n"])
    placed = classes.mapInPandas(
        _placed(axes, reach, kind),
        f"node long, weight long, label {label_type}, length int, "
        + ", ".join(f"{c} int" for c in CELLS)
        + ", data binary",
    )
    order = ["label", "length", *CELLS, "node"]
    parts = parts_for((size["values"] or 0) * 8, PART_BYTES)
    tiles = cut(
        placed.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(
            _tiles(axes, kind),
            f"tile long, length int, {CELLS[0]} int, {CELLS[1]} int, label {label_type}, "
            "low array<double>, high array<double>, data binary, nodes binary, weights binary",
        ),
        "vectors-tiles",
    )
    pairs = cut(_pairs(tiles, reach), "vectors-pairs")
    routes = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    sizes = tiles.select("tile", F.octet_length("data").alias("bytes"))
    moved = routes.join(sizes, "tile").agg(F.sum("bytes").alias("n")).first()["n"]
    lots = parts_for(moved, LOT_BYTES)
    met = routes.withColumn("lot", F.pmod(F.xxhash64("a", "b"), F.lit(lots))).join(
        tiles.select("tile", "length", "data", "nodes", "weights"), "tile"
    )
    found = cut(
        met.groupBy("lot").applyInPandas(
            _compare(threshold, axes, kind), "node long, links long, root long"
        ),
        "vectors-found",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select("node", "root"))
    known = (
        classes.join(links, "node", "left")
        .join(labels.withColumnRenamed("label", "root"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(names, "root").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    linked_rows = sound_rows.join(known, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.filter(~sound).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked_rows.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
