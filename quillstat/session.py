"""Spark session settings the pipelines rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# SQL settings that may be changed on a live session. Everything about cluster
# size (executors, memory, shuffle partitions) is left to the cluster.
SQL_SETTINGS = {
    # Day, month and hour boundaries are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Bad amounts and decimal overflow must stop the job, never turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Joins are written so that the side that can be hot is one Spark may split;
    # "force" lets it split inside a chain of joins on one key too.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The ids of some creators' rows cut the large tables before their shuffle, by a Bloom
    # filter; the join itself decides, so a full filter costs time only. Of 8 MB, it lets
    # through 1 % of the other rows at 6 million ids.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(8 << 23),
    "spark.sql.optimizer.runtimeFilter.number.threshold": "30",
    # A rebalanced task has few months, so it writes them side by side, without sorting its
    # rows by month first; with more months it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


# Spark's setting to remove the shuffle files of a query when it has ended.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside leave no shuffle files behind.

    Otherwise these stay until the driver happens to collect its garbage, so a run of many
    writes keeps nearly all it ever shuffled on disk. Running the same DataFrame twice inside
    would shuffle twice.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else made."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(cores: int | str = "*", app: str = "quillstat", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        # Recording the Python line of every column doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_dir(spark: SparkSession, name: str) -> str:
    """A new directory for one run, in a folder that driver and executors share.

    That is ``spark.checkpoint.dir``, or the warehouse where it is unset. The caller
    may delete the directory when its run is over; nothing else uses it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
