"""Fixed-capacity shards by best-fit-decreasing bin packing of indivisible groups.

Groups are rows with equal text. Packing is sequential by nature, so it runs on two
levels whose tasks both grow with the square root of the number of groups:

1. The groups are dealt by hash to packers. Each packer sorts its groups by size and
   puts each into the tightest bundle with room, found in a balanced tree. A bundle
   holds a small part of a shard; a larger group is a bundle of its own.
2. The bundles are packed into the shards the same way.

With a fixed number of shards the capacity is what they need at least; a bundle that
fits nowhere goes to the emptiest shard. Only sizes and keys are packed, never texts.
Slots are numbered without gathering a shard: rows are numbered within cells of a shard
and offset by the sizes of the cells before.

Defined results: null and empty texts are one group of size ``OVERHEAD`` per row and
checksum 0; rows with a null or repeated id are rows like any other; no rows give no
rows. Extra columns are ignored by ``assign`` and kept by ``deal``. A group larger than
a shard fills one shard alone as far as possible, as groups are indivisible.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.tables import cut, with_library

SHARDS = 24
OVERHEAD = 8


class RoomTree:
    """Bins by remaining room, as a balanced tree of two levels.

    Leaves are sorted runs of at most ``WIDTH`` entries and are split in half when they
    overflow, so a search or an update touches one leaf.
    """

    WIDTH = 512

    def __init__(self) -> None:
        self._leaves: list[list[tuple[int, int]]] = [[]]

    def _leaf(self, entry: tuple[int, int]) -> int:
        low, high = 0, len(self._leaves) - 1
        while low < high:
            middle = (low + high) // 2
            if self._leaves[middle][-1] < entry:
                low = middle + 1
            else:
                high = middle
        return low

    def add(self, room: int, number: int) -> None:
        at = self._leaf((room, number))
        leaf = self._leaves[at]
        insort(leaf, (room, number))
        if len(leaf) > self.WIDTH:
            half = len(leaf) // 2
            self._leaves[at : at + 1] = [leaf[:half], leaf[half:]]

    def _take(self, at: int, place: int) -> tuple[int, int]:
        entry = self._leaves[at].pop(place)
        if not self._leaves[at] and len(self._leaves) > 1:
            del self._leaves[at]
        return entry

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room that still fits ``size``."""
        at = self._leaf((size, -1))
        place = bisect_left(self._leaves[at], (size, -1))
        return self._take(at, place) if place < len(self._leaves[at]) else None

    def emptiest(self) -> tuple[int, int]:
        return self._take(-1, -1)


def best_fit(sizes: Sequence[int], capacity: int, bins: int | None = None) -> list[int]:
    """The bin of each size; sizes come in decreasing order.

    Without ``bins`` a new bin is opened whenever nothing fits, and a size above the
    capacity gets one to itself. With ``bins`` there are exactly so many, and what fits
    nowhere goes to the emptiest.
    """
    tree, chosen = RoomTree(), []
    opened = bins or 0
    for number in range(opened):
        tree.add(capacity, number)
    for size in sizes:
        found = tree.tightest(size)
        if found is None:
            if bins is None:
                found = (max(capacity, size), opened)
                opened += 1
            else:
                found = tree.emptiest()
        room, number = found
        tree.add(room - size, number)
        chosen.append(number)
    return chosen


def _even(groups: DataFrame, total: int, shards: int) -> int:
    """The capacity at which all shards are full, but for groups larger than that."""
    # At most as many rows as there are shards.
    large = groups.filter(F.col("size") > total / shards).select("size").collect()
    for (size,) in sorted(large, reverse=True):
        if size * shards <= total or shards == 1:
            break
        total, shards = total - size, shards - 1
    return max(1, -(-total // shards))


def pack(groups: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """Assign every group to a shard: ``key``, ``shard``.

    ``groups`` has one row per group, ``key`` and ``size``, and should be cheap to read.
    Either the number of shards is fixed, or their ``capacity``, which then gives as few
    shards as the method finds.
    """
    with_library(groups.sparkSession)
    count, total = groups.agg(F.count("key"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if capacity is None:
        capacity = _even(groups, total, shards)
    else:
        shards = None
    lots = max(1, total // capacity)
    packers = max(1, math.isqrt(count // lots))
    bundle = max(1, capacity // (4 * packers))

    def bundles(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "key"], ascending=[False, True])
        return pdf.assign(bundle=best_fit(pdf["size"].tolist(), bundle))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "packer", "bundle"], ascending=[False, True, True])
        return pdf.assign(shard=best_fit(pdf["size"].tolist(), capacity, shards))

    dealt = groups.select(F.pmod(F.xxhash64("key"), F.lit(packers)).alias("packer"), "key", "size")
    bundled = cut(
        dealt.groupBy("packer").applyInPandas(
            bundles, "packer long, key string, size long, bundle long"
        ),
        "sharding-bundles",
    )
    placed = (
        bundled.groupBy("packer", "bundle")
        .agg(F.sum("size").alias("size"))
        .groupBy(F.lit(0).alias("all"))
        .applyInPandas(
            lambda pdf: place(pdf)[["packer", "bundle", "shard"]],
            "packer long, bundle long, shard int",
        )
    )
    return bundled.join(placed, ["packer", "bundle"]).select("key", "shard")


def _slots(rows: DataFrame, order: Sequence[str], each: int) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in cells of about ``each`` rows."""
    cells = max(1, math.isqrt(each))
    celled = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    counts = celled.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    within = F.row_number().over(Window.partitionBy("shard", "cell").orderBy(*order)) - 1
    numbered = celled.withColumn("within", within.cast("bigint"))
    return (
        numbered.join(offsets, ["shard", "cell"])
        .withColumn("slot", F.col("offset") + F.col("within"))
        .drop("cell", "offset", "within")
    )


def _measures(text: Column) -> tuple[Column, Column, Column]:
    """Size, checksum and group key of a text."""
    known = F.coalesce(text, F.lit(""))
    size = (F.octet_length(known) + OVERHEAD).cast("bigint")
    return size, F.crc32(known), F.md5(known)


def _groups(rows: DataFrame) -> DataFrame:
    return cut(rows.groupBy("key").agg(F.sum("size").alias("size")), "sharding-groups")


def assign(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``."""
    size, checksum, key = _measures(F.col(text_col))
    rows = cut(
        docs.select(
            F.col(id_col).alias(id_col),
            size.alias("size"),
            checksum.alias("text_crc32"),
            key.alias("key"),
        ),
        "sharding-rows",
    )
    placed = rows.join(pack(_groups(rows), shards), "key")
    numbered = _slots(placed, [id_col, "key"], rows.count() // shards)
    return numbered.select(
        F.col(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def deal(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with all columns, and ``shard`` and ``slot``, which replace such columns."""
    size, _, key = _measures(F.col(text_col))
    rows = cut(docs.select(size.alias("size"), key.alias("key")), "sharding-rows")
    shard_of = pack(_groups(rows), shards)
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    tagged = docs.select(F.struct(*kept).alias("row"), F.col(id_col).alias("id"), key.alias("key"))
    numbered = _slots(tagged.join(shard_of, "key"), ["id", "key"], rows.count() // shards)
    return numbered.select("row.*", F.col("shard").cast("int").alias("shard"), "slot")
