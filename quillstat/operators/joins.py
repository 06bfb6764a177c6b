"""Equi-joins that stay balanced when one key holds a large share of the rows.

Both sides must have distinct column names; the result has all of them, so the
right key tells whether a row was matched. Where no key is hot these are the plain
Spark joins, which adaptive execution broadcasts or divides by real sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators.skew import NONE, Hot, Parts, all_parts, row_part

Ids = Sequence[str] | DataFrame


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    hot: Hot = NONE,
    null_keys: bool = False,
) -> DataFrame:
    """Left join to a table with few rows per key.

    The left rows of a hot key are divided into parts, and its right rows copied
    to each part. With ``null_keys`` left rows without a key, which can never match,
    are set aside before the join and take no part in its shuffle.
    """
    if null_keys:
        known = lookup(left.filter(F.col(left_on).isNotNull()), right, left_on, right_on, hot)
        return known.unionByName(_padded(left.filter(F.col(left_on).isNull()), right))
    same = F.col(left_on) == F.col(right_on)
    if not hot.left:
        return left.join(right, same, "left")
    parts = hot.left.of(F.col(left_on))
    part = F.when(parts > 1, row_part(left, parts)).otherwise(0)
    joined = left.withColumn("_part", part).join(
        right.withColumn("_copy", all_parts(hot.left.of(F.col(right_on)))),
        same & (F.col("_part") == F.col("_copy")),
        "left",
    )
    return joined.drop("_part", "_copy")


def pair(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, hot: Hot = NONE
) -> DataFrame:
    """Inner join in which a key may be hot on either side, or in the product.

    Each side divides the rows of its hot keys and copies its rows to all parts of
    the other side's. Every pair of rows meets in exactly one place.
    """
    same = F.col(left_on) == F.col(right_on)
    columns = left.columns + right.columns

    def own(df: DataFrame, on: str, keys: Parts):
        parts = keys.of(F.col(on))
        return F.when(parts > 1, row_part(df, parts)).otherwise(0)

    def copies(on: str, keys: Parts):
        return all_parts(keys.of(F.col(on)))

    lefts, rights = left, right
    if hot.left:
        lefts = lefts.withColumn("_left_part", own(left, left_on, hot.left))
        rights = rights.withColumn("_left_copy", copies(right_on, hot.left))
        same = same & (F.col("_left_part") == F.col("_left_copy"))
    if hot.right:
        rights = rights.withColumn("_right_part", own(right, right_on, hot.right))
        lefts = lefts.withColumn("_right_copy", copies(left_on, hot.right))
        same = same & (F.col("_right_part") == F.col("_right_copy"))
    return lefts.join(rights, same, "inner").select(*columns)


def fan_out(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    hot: Hot = NONE,
    keys: DataFrame | None = None,
    null_keys: bool = False,
) -> DataFrame:
    """Left join to a table that may hold very many rows of one key.

    A left join cannot divide its right side, as every part would have to know
    whether another one matched. So if a right key is hot, the matched rows come
    from an inner join and the others from a check against the distinct keys, which
    are reduced before they are shuffled. ``keys`` is a table with the same keys
    that is cheaper than ``right``, if there is one; its first column counts.
    """
    if not hot.right:
        return lookup(left, right, left_on, right_on, hot, null_keys)
    matched = pair(left, right, left_on, right_on, hot)
    keys = right.select(right_on) if keys is None else keys
    distinct = keys.select(F.col(keys.columns[0]).alias("_known")).distinct()
    checked = lookup(left, distinct, left_on, "_known", hot, null_keys)
    unmatched = checked.filter(F.col("_known").isNull()).drop("_known")
    return matched.unionByName(_padded(unmatched, right))


def _padded(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows that match nothing: the right columns are NULL."""
    padding = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
    return left.select(*left.columns, *padding)


def restrict_to(df: DataFrame, ids: Ids | None, on: str, few: bool = False) -> DataFrame:
    """Rows whose key is in ``ids``; an id listed twice repeats nothing.

    A literal list becomes a predicate that reaches the scan; a table becomes a
    left semi join on its first column, reduced to distinct ids first. With ``few``
    the caller expects few rows per id and they are not reduced: Spark builds its
    runtime filters from a selection only, not from an aggregate of one.
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        listed = ids.select(F.col(ids.columns[0]).alias(on))
        return df.join(listed if few else listed.distinct(), on, "left_semi").select(*df.columns)
    return df.filter(F.col(on).isin(list(ids)))
