"""Reading the tables, cutting lineage, and joining with checked broadcasts."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that separate words; everything else is part of one.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
# Rows of a file of pairs of numbers, and of wider rows with a key as text.
LINK_ROWS = 100_000
KEY_ROWS = 20_000
# Bytes of a batch of rows between Spark and Python.
BATCH_BYTES = 4_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share.

    It lies in ``spark.checkpoint.dir``, or in the warehouse where that is unset.
    The caller of the operator may delete it once the result is read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so lost executors cost nothing.

    With ``files``, tasks are merged so that at most so many write. A small table should not
    have a file for each shuffle partition: an executor opens each on its own, and on a
    local file system starts processes to set its mode.
    """
    path = scratch(df.sparkSession, name)
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_library(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in batches of a few MB, unless the session has smaller ones.

    Executors keep the memory of the largest batch that they have sent.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``df``, which should be cheap to count, has at most ``limit`` rows.

    With more rows the same join runs as a shuffle, whose skew Spark splits.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def text_of(column: str) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def parts_for(amount: int | None, each: int) -> int:
    """How many parts of about ``each`` hold ``amount``; at least one."""
    return max(1, -(-int(amount or 0) // each))
