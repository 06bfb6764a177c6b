"""Full-refresh writes and the hop that keeps timestamps as integers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.functions.calendar import from_micros, to_micros


# Products are written once and read often; zstd takes a third less disk than Spark's default.
COMPRESSION = "zstd"
# Row groups are what a reader skips by the least and the largest value of a sorted column.
ROW_GROUP_BYTES = 16 << 20


def write_files(
    df: DataFrame,
    path: str,
    month: str | None = None,
    cluster: Sequence[str] = (),
    unpack: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    gathered: bool = False,
) -> str:
    """Write a product to a new directory and return it.

    An existing directory is an error: readers of the last run keep theirs, and
    nobody sees half a table. With ``cluster`` the rows of a file are sorted by these
    columns, so a predicate on the first reads few of its row groups and pages. What
    ``unpack`` adds to the rows is not shuffled or sorted; it must keep their order. Rows
    that come ``gathered`` by month, from files that are, stay where they are.
    """
    _writer(df, month, cluster, unpack, gathered).mode("error").parquet(path)
    return path


def replace_table(df: DataFrame, name: str, path: str, month: str | None = None) -> None:
    """Create or replace a catalog table, as a view of files in a new directory.

    The name points to the old files until all new ones are written, so readers see
    either table whole. ``name`` and ``path`` are the caller's own, not user input.
    """
    write_files(df, path, month)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def _writer(
    df: DataFrame,
    month: str | None,
    cluster: Sequence[str],
    unpack: Callable[[DataFrame], DataFrame],
    gathered: bool,
):
    months = [] if month is None else [month]
    if months and not gathered:
        # Rebalancing sends a month to few writers, and splits it again when large.
        df = df.hint("rebalance", month)
    if cluster:
        # The writer's own sort by month is part of this one.
        df = df.sortWithinPartitions(*months, *cluster)
    writer = unpack(df).write.partitionBy(*months).option("compression", COMPRESSION)
    return writer.option("parquet.block.size", ROW_GROUP_BYTES) if cluster else writer


def export_times(df: DataFrame) -> DataFrame:
    """Timestamps as integer microseconds, the form they have after the hop."""
    return df.select(
        *[
            to_micros(F.col(name)).alias(name) if kind.startswith("timestamp") else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def import_times(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named microsecond columns as timestamps again."""
    return df.select(
        *[from_micros(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
