"""Reading the given tables and cutting lineage in the shared folder."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application; they may not share the driver's paths."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="cartwheel-")
        context.addPyFile(shutil.make_archive(f"{folder}/cartwheel", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def in_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` by a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


#: Arrow batches between the JVM and Python, each of which holds a batch several times over: as vectors, as bytes on the way and as arrays.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends ``BATCHES`` at most, where it does not set sizes itself. Spark reads them when a plan is run."""
    for setting, most in BATCHES.items():
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """The rows, written once below ``spark.checkpoint.dir`` and read back.

    A lost executor then costs the reading tasks only, and every later plan sees the same rows.
    """
    folder = scratch(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def numbered(rows: DataFrame, purpose: str, column: str = "row") -> DataFrame:
    """``rows`` with a row number, written once with it.

    How a scan is cut into partitions depends on the cores registered when it is planned, so a number computed
    twice need not be the same; these are only ever read.
    """
    return saved(rows.select("*", F.monotonically_increasing_id().alias(column)), purpose)


ROW_IDS = 2_000_000  # long row numbers, of 16 bytes in a hash table, that may be broadcast


def rows_in(docs: DataFrame, rows: DataFrame, *, keep: bool, column: str = "row") -> DataFrame:
    """``docs`` whose row number is, or is not, in the saved table ``rows``.

    The numbers are broadcast up to ``ROW_IDS`` of them, so that texts are not shuffled; beyond that Spark joins both sides.
    """
    small = F.broadcast(rows) if rows.count() <= ROW_IDS else rows
    return docs.join(small, column, "left_semi" if keep else "left_anti")
