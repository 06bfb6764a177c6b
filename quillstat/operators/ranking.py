"""First row per group, and flags relative to it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must leave no ties.

    Rows without a key are dropped, as the result is only ever joined on it.
    Filtering ``row_number`` to 1 lets Spark keep one row per key in every map
    task, so a hot key sends one row per task through the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    ranked = df.filter(F.col(key).isNotNull()).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def not_first(
    df: DataFrame,
    flags: Mapping[str, tuple[str, Sequence[str]]],
    unique: bool = False,
) -> DataFrame:
    """Add flags, each false on the first row of its key and true on all others.

    ``flags`` gives the key of each flag and the columns that sort its rows, ascending with
    NULL first; the other columns break ties. NULL is a key like any other. The first
    row of a key is a minimum, which every task reduces before the shuffle, and rows
    meet these minima on all their columns. So however many rows a key has, they are
    moved once, evenly, and for all flags together. Of equal rows exactly one is first;
    with ``unique`` the caller knows that there are none.
    """
    rows = df.withColumn("_row", F.struct(*df.columns))
    copy = F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(1)))
    flagged = rows if unique else rows.withColumn("_copy", copy)
    again = F.lit(False) if unique else F.col("_copy") > 1
    for flag, (key, order) in flags.items():
        place = F.struct(*order, *[c for c in df.columns if c not in order])
        first = F.min(F.struct(place.alias("place"), F.col("_row").alias("row")))
        firsts = rows.groupBy(F.col(key).alias(f"_{flag}_key")).agg(first["row"].alias(f"_{flag}"))
        flagged = flagged.join(
            firsts.select(f"_{flag}"), F.col("_row") == F.col(f"_{flag}"), "left"
        )
    columns = [(F.col(f"_{f}").isNull() | again).alias(f) for f in flags]
    return flagged.select(*df.columns, *columns)
