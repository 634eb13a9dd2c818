"""The latest row per key of a growing history, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.incremental.buckets import BUCKET, PartitionedState, bucket_of, touched, written_once
from cartwheel.model import STAMP, VERSION
from cartwheel.operators.versions import by_age, newest_per_key


class Snapshot:
    """A snapshot table in buckets by a hash of its key.

    After all batches of a history were applied, in any order, it holds what ``current_snapshot`` finds in all of them. A batch
    costs its own rows and the buckets they fall into. Choose ``buckets`` so that one holds about a gigabyte;
    the number is part of the layout and must stay.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        *,
        buckets: int = 64,
        version: str | None = VERSION,
        stamp: str | None = STAMP,
    ) -> None:
        if not keys:
            raise ValueError("a snapshot needs a key")
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.version, self.stamp = version, stamp
        self.state = PartitionedState(spark, path, [BUCKET])

    def read(self) -> DataFrame | None:
        """The latest row per key, or None before the first batch."""
        rows = self.state.read()
        return None if rows is None else rows.drop(BUCKET)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return newest_per_key(rows, [BUCKET, *self.keys], by_age(rows, self.version, self.stamp))

    def _held(self, like: DataFrame, numbers: list[int]) -> DataFrame:
        """The rows of these buckets, with the columns of ``like``."""
        held = self.state.read()
        if held is None or not numbers:
            return self.spark.createDataFrame([], like.schema)
        return held.where(F.col(BUCKET).isin(numbers)).select(*like.columns)

    def changes(self, batch: DataFrame) -> DataFrame:
        """The keys whose row a batch changes, with the row ``before`` (NULL if new) and ``after``; the table stays as it is.

        Rows without a full key are left out.
        """
        columns, key = batch.columns, [BUCKET, *self.keys]
        complete = batch.dropna(subset=self.keys).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        fresh = written_once(self._newest(complete), "batch")
        held = self._held(fresh, [number for (number,) in touched(fresh, BUCKET)])
        before = written_once(held.join(fresh.select(*key), key, "left_semi").select(*fresh.columns), "before")
        after = self._newest(before.unionByName(fresh))
        old = before.select(*key, F.struct(*columns).alias("before"))
        new = after.select(*key, F.struct(*columns).alias("after"))
        changed = new.join(old, key, "left").where(~F.col("before").eqNullSafe(F.col("after")))
        return written_once(changed.select(*self.keys, "before", "after"), "changes")

    def _merged(self, changes: DataFrame, numbers: list[int] | None = None) -> DataFrame:
        after = changes.select("after.*").withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        if numbers is None:
            numbers = list(range(self.buckets))
        key = [BUCKET, *self.keys]
        same = self._held(after, numbers).join(after.select(*key), key, "left_anti")
        return same.select(*after.columns).unionByName(after)

    def preview(self, changes: DataFrame) -> DataFrame:
        """The table as it will be after the changes."""
        return self._merged(changes).drop(BUCKET)

    def merge(self, changes: DataFrame) -> None:
        """Write the buckets that the changes fall into."""
        numbers = [number for (number,) in touched(changes.select(bucket_of(self.keys, self.buckets).alias(BUCKET)), BUCKET)]
        if numbers:
            self.state.replace(self._merged(changes, numbers))

    def apply(self, batch: DataFrame) -> DataFrame:
        """Merge a batch and return its changes. Applying a batch again changes nothing."""
        changes = self.changes(batch)
        self.merge(changes)
        return changes

    def rebuild(self, history: DataFrame) -> None:
        """Write the whole table anew from all batches."""
        latest = self._newest(history.dropna(subset=self.keys).withColumn(BUCKET, bucket_of(self.keys, self.buckets)))
        self.state.replace(latest)
