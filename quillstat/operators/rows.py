"""Literal tables, generated days and unions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.schemas import align, struct


def literal_table(spark: SparkSession, columns: dict[str, list[str]], spec: str) -> DataFrame:
    """A small table held in the plan itself, so that no job is needed to read it."""
    texts = spark.createDataFrame(pa.table(columns))
    return texts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct(spec)])


def days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row ``date`` per day from ``first`` to ``last``, both included."""
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence(first, last, step)).alias("date"))


def repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column ``copies`` says, without this column."""
    columns = [c for c in df.columns if c != copies]
    times = F.sequence(F.lit(1).cast("bigint"), F.col(copies))
    return df.select(*columns, F.explode(times).alias(copies)).select(*columns)


def at_most(df: DataFrame, copies: str, most: int) -> DataFrame:
    """Rows that stand for more than ``most`` copies become several that do not."""
    done = F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, F.lit(most).cast("bigint"))
    divided = df.withColumn("_done", F.explode(done))
    left = F.least(F.col(copies) - F.col("_done"), F.lit(most))
    return divided.withColumn(copies, left).drop("_done")


def union_as(branches: Iterable[DataFrame], spec: str) -> DataFrame:
    """Union of differently built branches, each brought to one schema first."""
    return reduce(DataFrame.unionByName, [align(b, spec) for b in branches])
