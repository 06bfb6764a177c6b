"""Runs of a refresh: what is finished, what was counted, and which run readers see.

A run is a folder. Each finished product is one line in the run's list, with the folder it
was written to and what was counted while it was written; a product whose write broke off
has no line, and its folder is never read. So a run that is started again with the same
folder goes on after its last finished product. Only a whole run is published, by one
line in the list of the base folder, which Spark puts in place by a rename: readers see
the old run or the new one.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillstat.schemas import PRODUCTS, check, struct
from quillstat.sources.sinks import write_files
from quillstat.sources.tables import read_product

_LINE = "product string, path string, number_row bigint, nulls map<string,bigint>"
_PUBLISHED = "run string, published timestamp"


def _append(spark: SparkSession, path: str, line: DataFrame) -> None:
    line.coalesce(1).write.mode("append").json(path)


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines of a list; none where nothing was written yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Run:
    """The products of one run, written in order or taken over from an earlier attempt."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        # Two jobs that append to one folder would clear each other's temporary files.
        self._lock = threading.Lock()
        self._listed = {r["product"]: r for r in self.lines().collect()}

    def lines(self) -> DataFrame:
        """Per finished product its folder, its rows, and per column those without a value."""
        return _lines(self.spark, f"{self.root}/_products", _LINE)

    def has(self, name: str) -> bool:
        return name in self._listed

    def read(self, name: str) -> DataFrame:
        return read_product(self.spark, self._listed[name]["path"], name)

    def products(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in self._listed}

    def put(
        self,
        name: str,
        build: Callable[[], DataFrame],
        month: str | None = None,
        cluster: Sequence[str] = (),
        unpack: Callable[[DataFrame], DataFrame] | None = None,
        gathered: bool = False,
    ) -> DataFrame:
        """Write a product and read it back, or read it if it is finished already.

        Rows and missing values are counted by the write itself, without another scan. With
        ``unpack`` the product is what it makes of the rows that were built; ``gathered`` rows
        come from files by month.
        """
        if not self.has(name):
            columns = struct(PRODUCTS[name]).names
            counted = Observation(f"{name}-{uuid.uuid4().hex}")
            nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in columns]
            path = f"{self.root}/{name}-{uuid.uuid4().hex}"

            def observed(df: DataFrame) -> DataFrame:
                whole = check(df, PRODUCTS[name])
                return whole.observe(counted, F.count(F.lit(1)).alias("number_row"), *nulls)

            if unpack is None:
                write_files(observed(build()), path, month, cluster, gathered=gathered)
            else:
                write_files(build(), path, month, cluster, lambda df: observed(unpack(df)))
            found = counted.get
            self._list(name, path, found["number_row"], {c: found[f"null_{c}"] for c in columns})
        return self.read(name)

    def _list(self, name: str, path: str, rows: int, nulls: dict[str, int]) -> None:
        row = {"product": name, "path": path, "number_row": rows, "nulls": nulls}
        with self._lock:
            _append(self.spark, f"{self.root}/_products", self.spark.createDataFrame([row], _LINE))
            self._listed[name] = row

def together(*tasks: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run tasks that do not depend on each other at the same time; the first error is raised
    when all have ended."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [done.result() for done in [pool.submit(task) for task in tasks]]


def publish(spark: SparkSession, base: str, root: str) -> None:
    """Let readers of ``base`` see the run in ``root``, which must be whole."""
    missing = sorted(name for name in PRODUCTS if not Run(spark, root).has(name))
    if missing:
        raise ValueError(f"products missing: {', '.join(missing)}")
    line = spark.range(1).select(F.lit(root).alias("run"), F.current_timestamp().alias("published"))
    _append(spark, f"{base}/_published", line)


def published(spark: SparkSession, base: str) -> Run | None:
    """The run published last, or none."""
    last = _lines(spark, f"{base}/_published", _PUBLISHED).orderBy(F.desc("published"), F.desc("run"))
    found = last.first()
    return Run(spark, found["run"]) if found else None
