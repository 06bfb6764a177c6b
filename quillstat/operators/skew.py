"""Finding keys whose rows are more than one task's share, and dividing their rows.

A key is hot in a join if the rows it makes are more than one shuffle partition's
share of all that the join makes. Fewer keys than partitions can be, so what comes
to the driver is bounded without a limit. Hot keys are found on a sample and handed to
the joins as literals, so that both sides of a join and every retry of a task agree on
them. The sample decides only which keys are divided, never which rows are returned.

Nothing here runs unless a caller asks for it: the builders of the products take hot
keys as an argument and leave skew to adaptive execution without one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import mul
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 0.01
# A key seen less often in the sample is not told from one with few rows.
SURE = 30


@dataclass(frozen=True)
class Parts:
    """The number of parts that the rows of each hot key are divided into."""

    keys: Mapping[str, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.keys)

    def of(self, key: Column) -> Column:
        """Number of parts of a key, 1 for any that is not hot."""
        number = F.lit(1)
        for n in sorted(set(self.keys.values())):
            same = sorted(k for k, parts in self.keys.items() if parts == n)
            number = F.when(key.isin(same), n).otherwise(number)
        return number


@dataclass(frozen=True)
class Hot:
    """The hot keys of one join. Parts of the left side meet all parts of the right."""

    left: Parts = Parts()
    right: Parts = Parts()

    def __bool__(self) -> bool:
        return bool(self.left or self.right)

    def turned(self) -> Hot:
        """The same join seen from its right side."""
        return Hot(self.right, self.left)

    def onward(self) -> Parts:
        """Parts of what the join makes, where that is the left side of the next join.

        A key's rows are by then those of both sides multiplied, and so are its parts: the
        next join must not bring together what this one kept apart.
        """
        keys = self.left.keys | self.right.keys
        return Parts({k: self.left.keys.get(k, 1) * self.right.keys.get(k, 1) for k in keys})

    def after(self, before: Hot) -> Hot:
        """This join as the next one after ``before``: divided at least as finely on the left."""
        made = before.onward().keys
        keys = self.left.keys | made
        left = {k: max(self.left.keys.get(k, 1), made.get(k, 1)) for k in keys}
        return Hot(Parts(left), self.right)


NONE = Hot()
NO_HOT: Mapping[str, Hot] = MappingProxyType({})
# Tables and keys of a join: the left one, and those whose rows the right one multiplies;
# tables with unique keys are left out. With a third value that is true, equal rows of the table
# count once.
Sides = Sequence[tuple[DataFrame, str] | tuple[DataFrame, str, bool]]


def find_hot(
    joins: Mapping[str, Sides],
    sample: float = SAMPLE,
    sure: int = SURE,
    partitions: int | None = None,
) -> dict[str, Hot]:
    """Hot keys of several joins, in one job that reads only the key columns.

    A join makes the product of a key's rows on both sides, so a key that is hot on
    neither side alone can be hot in the join; it is divided on the larger side first.
    """
    if not joins:
        return {}
    if partitions is None:
        spark = next(iter(joins.values()))[0][0].sparkSession
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keys(name: str, side: int, df: DataFrame, column: str, once: bool = False) -> DataFrame:
        rows = sample_once(df, sample) if once else df
        shown = rows.select(F.lit(name).alias("name"), F.lit(side).alias("side"), F.col(column).alias("key"))
        return (shown if once else shown.sample(sample, seed=7)).filter(F.col("key").isNotNull())

    seen = [keys(n, i, *side) for n, sides in joins.items() for i, side in enumerate(sides)]
    places = range(max(len(sides) for sides in joins.values()))
    counts = (
        reduce(DataFrame.unionByName, seen)
        .groupBy("name", "key")
        .agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in places])
    )

    def estimate(count: Column) -> Column:
        """Rows of a side; a key that is not surely more than one row is one."""
        return F.when(count >= sure, count / sample).otherwise(F.lit(1.0))

    right = [estimate(F.col(f"n{i}")) for i in places[1:]]
    rows = (
        counts.withColumn("left_rows", F.col("n0") / sample)
        .withColumn("right_rows", reduce(mul, right, F.lit(1.0)))
        .withColumn("work", F.col("left_rows") * F.col("right_rows"))
        .withColumn("seen", sum((F.col(f"n{i}") for i in places[1:]), F.col("n0")))
    )
    totals = rows.groupBy(F.col("name").alias("of")).agg(F.sum("work").alias("total"))
    # One row per join.
    hot = rows.join(F.broadcast(totals), F.col("name") == F.col("of")).filter(
        (F.col("work") * partitions > F.col("total")) & (F.col("seen") >= sure)
    )
    factor = F.ceil(F.col("work") * partitions / F.col("total"))
    found: dict[str, tuple[dict, dict]] = {name: ({}, {}) for name in joins}
    chosen = hot.select("name", "key", factor, "left_rows", "right_rows")
    for name, key, wanted, left_rows, right_rows in chosen.collect():
        lefts, rights = divide(int(wanted), left_rows, max(right_rows, 1.0))
        for parts, n in zip(found[name], (lefts, rights), strict=True):
            if n > 1:
                parts[key] = n
    return {name: Hot(Parts(left), Parts(right)) for name, (left, right) in found.items()}


def sample_once(df: DataFrame, sample: float) -> DataFrame:
    """A sample of the distinct rows, drawn before equal rows are brought together."""
    drawn = F.pmod(F.xxhash64(*df.columns), F.lit(1_000_000))
    return df.filter(drawn < sample * 1_000_000).distinct()


def divide(wanted: int, left_rows: float, right_rows: float) -> tuple[int, int]:
    """Parts of both sides whose product is at least ``wanted``, about equal in rows."""
    left = min(wanted, max(1, round((wanted * left_rows / right_rows) ** 0.5)))
    return left, -(-wanted // left)


def row_part(df: DataFrame, parts: Column) -> Column:
    """A part below ``parts`` for every row, the same whenever a task is run again.

    It depends on the row and on its partition, not on the order of rows, which
    may change with a retry. The partition tells copies of one row apart. All columns
    are hashed, so callers select the ones they need first.
    """
    row = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    return F.pmod(row, parts.cast("bigint")).cast("int")


def all_parts(parts: Column) -> Column:
    """One row for each part."""
    return F.explode(F.sequence(F.lit(0), parts - 1))
