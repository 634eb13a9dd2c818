"""The curated marts of customers, funnel and attribution, brought up to date with what arrived in the trusted layer.

Where ``load_curated`` builds every output from whole histories, this job reads the rows stamped since its last run and merges them into
states: snapshots of orders and of click events, spending per customer, the funnel's days and the attribution's credits. The outputs are made from the
states. Orders may change in any way; click events may come again, but not with other content.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.incremental.attribution import BATCH, Attribution
from cartwheel.incremental.buckets import written_once
from cartwheel.incremental.funnel import FunnelDays
from cartwheel.incremental.snapshots import Snapshot
from cartwheel.incremental.spending import Spending
from cartwheel.model import PRIMARY_KEYS, STAMP, VERSION
from cartwheel.operators.versions import current_snapshot
from cartwheel.plans import rfm
from cartwheel.plans.layers import CURATED_COLUMNS, join_path
from cartwheel.sinks import tables
from cartwheel.sinks.watermarks import Watermarks
from cartwheel.sources import files

# What is recorded of each table: the stamp a run set out to reach, the one the derived states hold, the one all states hold.
BEGUN, APPLIED, DONE = "states-begun", "states-applied", "states"


class _Feed:
    """The rows of a trusted table that its states lack, up to a stamp that stays the same when a run is repeated."""

    def __init__(self, spark: SparkSession, trusted_path: str, table: str, watermarks: Watermarks) -> None:
        self.table, self.watermarks = table, watermarks
        self.done, self.applied, self.upto = (watermarks.get(layer, table) for layer in (DONE, APPLIED, BEGUN))
        self.rows: DataFrame | None = None
        history = files.parquet_if_any(spark, join_path(trusted_path, table))
        if history is None:
            return
        new = files.changed_since(history, STAMP, self.done)
        if self.upto <= self.done:
            (highest,) = new.agg(F.max(STAMP).cast("string")).first()
            if highest is None:
                return
            self.upto = highest
            watermarks.put(BEGUN, table, highest)
        wanted = {*CURATED_COLUMNS[table], *PRIMARY_KEYS[table], VERSION, STAMP}
        narrow = new.select(*(name for name in history.columns if name in wanted))
        self.rows = narrow.where(F.col(STAMP) <= F.lit(self.upto).cast("timestamp"))

    def merge(self, snapshot: Snapshot, derive: Callable[[DataFrame, str], None]) -> bool:
        """Bring the derived states and then the snapshot up to date. Returns whether there was anything new."""
        if self.rows is None:
            return False
        changes = snapshot.changes(self.rows)
        if self.applied < self.upto:
            derive(changes, self.upto)
            self.watermarks.put(APPLIED, self.table, self.upto)
        snapshot.merge(changes)
        self.watermarks.put(DONE, self.table, self.upto)
        return True


def update_curated(
    spark: SparkSession,
    trusted_path: str,
    state_path: str,
    curated_path: str,
    watermarks: Watermarks,
    *,
    as_of: dt.date | str | None = None,
) -> list[str]:
    """Merge what is new and write the outputs it concerns; returns their names.

    States derived from a table take in its changes before its snapshot does, under the stamp the run set out to reach, and taking them in twice
    changes nothing. A run that dies is repeated up to the same stamp.
    """
    written = []

    def small(table: str) -> DataFrame | None:
        history = files.parquet_if_any(spark, join_path(trusted_path, table))
        return None if history is None else current_snapshot(history, PRIMARY_KEYS[table])

    def put(content: DataFrame | None, name: str) -> None:
        if content is not None:
            tables.replace(content, join_path(curated_path, name))
            written.append(name)

    orders = Snapshot(spark, f"{state_path}/orders", PRIMARY_KEYS["orders"])
    spending = Spending(spark, f"{state_path}/spending")

    def spend(changes: DataFrame, batch: str) -> None:
        spending.apply(changes, orders.preview(changes), batch)

    _Feed(spark, trusted_path, "orders", watermarks).merge(orders, spend)
    spent, users = spending.read(), small("users")
    if spent is not None and users is not None:  # also without new orders, as users change and the report date moves
        put(rfm.segments(spent, users, as_of=as_of), "gold_q2_rfm_segmentation")

    clicks = Snapshot(spark, f"{state_path}/clickstream", PRIMARY_KEYS["clickstream"], version=None)
    funnel, attribution = FunnelDays(spark, f"{state_path}/funnel"), Attribution(spark, f"{state_path}/attribution")

    def count(changes: DataFrame, batch: str) -> None:
        new = written_once(changes.where("before IS NULL").select("after.*").withColumn(BATCH, F.lit(batch)), "new-events")
        funnel.refresh(new, BATCH, [batch])
        attribution.add(new, batch.replace(":", "-"))

    if _Feed(spark, trusted_path, "clickstream", watermarks).merge(clicks, count):
        categories, channels = small("categories"), small("marketing_channels")
        if categories is not None:
            put(funnel.funnel(categories), "gold_q1_conversion_funnel")
        if channels is not None:
            put(attribution.credits_of(channels), "gold_q5_attribution")
    return written
