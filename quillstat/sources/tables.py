"""Raw tables in; month pruning on the way back from a written product."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.functions.calendar import month_start
from quillstat.schemas import PRODUCTS, RAW, align, struct


class Sources:
    """The raw tables as attributes, e.g. ``sources.publication_record``.

    A table is read, and brought to its schema, when it is first asked for.
    """

    def __init__(self, readers: Mapping[str, Callable[[], DataFrame]]):
        missing = sorted(set(RAW) - set(readers))
        if missing:
            raise ValueError(f"raw tables missing: {', '.join(missing)}")
        self._readers = dict(readers)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in RAW:
            raise AttributeError(name)
        table = align(self._readers[name](), RAW[name])
        setattr(self, name, table)
        return table


def with_tables(sources: Sources, **tables: DataFrame) -> Sources:
    """The same raw tables, but for the ones given."""
    readers = {n: (lambda n=n: getattr(sources, n)) for n in RAW}
    return Sources(readers | {n: (lambda df=df: df) for n, df in tables.items()})


def from_parquet(spark: SparkSession, root: str) -> Sources:
    """Read ``<root>/<table>`` with declared schemas, so that nothing is inferred."""

    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(struct(RAW[name])).parquet(f"{root}/{name}")

    return Sources({name: reader(name) for name in RAW})


def from_catalog(spark: SparkSession, names: Mapping[str, str]) -> Sources:
    """Read catalog tables, given the table name of each raw table."""

    def reader(table: str) -> Callable[[], DataFrame]:
        return lambda: spark.table(table)

    return Sources({name: reader(table) for name, table in names.items()})


def read_product(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a written product with its columns in their declared order."""
    schema = struct(PRODUCTS[name])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def between(df: DataFrame, date: str, month: str, first: str, last: str) -> DataFrame:
    """Rows of a date range, bounding the month as well.

    A predicate on the date alone cannot skip month partitions.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    return df.filter(
        F.col(month).between(month_start(low), month_start(high)) & F.col(date).between(low, high)
    )
