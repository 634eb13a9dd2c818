"""Tables cut into buckets by a hash of their key, of which an update reads and writes the touched ones alone."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import storage
from cartwheel.session import scratch

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A number below ``buckets``, the same for equal keys; NULL is a value like any other."""
    return F.pmod(F.xxhash64(*(F.col(name).cast("string") for name in keys)), F.lit(buckets)).cast("int")


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below the shared scratch folder and read back; later changes of their sources do not reach them."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class PartitionedState:
    """A Parquet table that is updated by replacing some of its partitions.

    The new files are moved in when all of them are written, one partition after another. An update that dies before changes nothing and is
    repeated; one that dies in the middle of the moves may leave a partition without rows, and the table is then rebuilt from its history.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

        self._schema_path = f"{self.path}/_schema"

    def read(self) -> DataFrame | None:
        """The whole table, or None where nothing has been written yet. Its columns are kept beside it, so no data file is opened for them."""
        if not storage.exists(self.spark, self._schema_path):
            return None
        (described,) = self.spark.read.text(self._schema_path, wholetext=True).first()
        return self.spark.read.schema(T.StructType.fromJson(json.loads(described))).parquet(self.path)

    def replace(self, rows: DataFrame) -> None:
        """Put the partitions that ``rows`` hold in place of the old ones; all others stay as they are.

        A partition is written by the tasks its rows are shuffled to, so it does not fall into many small files;
        a large one is split by adaptive execution.
        """
        (
            rows.repartition(*self.partition_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )
        if not storage.exists(self.spark, self._schema_path):
            described = rows.select(*(name for name in rows.columns if name not in self.partition_by), *self.partition_by).schema.json()
            self.spark.createDataFrame([(described,)], "value string").coalesce(1).write.text(self._schema_path)


def touched(rows: DataFrame, *columns: str) -> list[tuple]:
    """The distinct partitions that rows fall into, at most as many as the table has."""
    return sorted(map(tuple, rows.select(*columns).distinct().collect()))
