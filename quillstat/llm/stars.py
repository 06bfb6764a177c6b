"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.tables import LINK_ROWS, cut, parts_for


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _print(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node but the least.

    ``edges`` has two columns of one ordered type. Each step halves long paths or better;
    it ends when a step changes nothing, and then every node is linked to its label. All
    steps are joins and aggregates, written to the shared folder one by one. A step makes
    at most two links of each, and its files follow from their number; ``files`` is the
    most for the edges themselves, whose number is not known.
    """
    edges = edges.toDF("u", "v").filter(F.col("u") != F.col("v"))
    now, before = cut(edges.distinct(), "stars", files), None
    while True:
        after = _print(now)
        if after == before or not after[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = after
        now = cut(
            _small(_large(now).distinct()).filter(F.col("u") != F.col("v")).distinct(),
            "stars",
            parts_for(2 * after[0], LINK_ROWS),
        )
