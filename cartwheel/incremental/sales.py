"""Sales per product in trailing windows, moved along instead of being summed again.

Order lines are kept by month of their order, and so are the totals per day and product made of them. Both windows of the inventory
report are sums over days: when the report date moves, the days that enter or leave at the windows' ends are added or taken off, and
when lines of a day change, so does the difference in its totals. Only the months of these days are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import storage
from cartwheel.incremental.buckets import PartitionedState, touched, written_once
from cartwheel.plans.inventory import LONG_WINDOW, SHORT_WINDOW
from cartwheel.plans.rfm import settled
from cartwheel.sinks import tables

MONTH = "_month"
WINDOWS = {"sold_short": SHORT_WINDOW, "sold_long": LONG_WINDOW}


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def dated_lines(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their order's date and status and its month, by which they are to be partitioned."""
    heads = orders.select("order_id", F.to_date("order_date").alias("day"), "status")
    lines = order_items.select("order_id", "product_id", "quantity").join(heads, "order_id")
    return lines.where("day IS NOT NULL").withColumn(MONTH, month_of("day"))


class TrailingSales:
    """Totals per month, day and product, and the sums of both windows at a report date."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.days = PartitionedState(spark, f"{path}/days", [MONTH])
        self.windows = f"{path}/windows"

    def _window_state(self) -> tuple[DataFrame, dt.date] | None:
        if not storage.exists(self.spark, self.windows):
            return None
        rows = self.spark.read.parquet(self.windows)
        (as_of,) = rows.agg(F.max("as_of")).first()
        return rows, as_of

    def _move(self, changes: DataFrame, as_of: dt.date) -> None:
        """Add changes (product_id, sold_short, sold_long) to the windows."""
        state = self._window_state()
        changes = changes.select("product_id", *WINDOWS)
        if state:
            changes = changes.unionByName(state[0].select("product_id", *WINDOWS))
        summed = changes.groupBy("product_id").agg(*(F.sum(name).alias(name) for name in WINDOWS))
        dated = summed.withColumn("as_of", F.lit(as_of))
        # One row without a product tells the date where nothing was sold.
        mark = self.spark.range(1).select(
            F.lit(None).cast(dated.schema["product_id"].dataType).alias("product_id"),
            *(F.lit(0).cast("bigint").alias(name) for name in WINDOWS),
            F.lit(as_of).alias("as_of"),
        )
        tables.replace(written_once(dated.where("product_id IS NOT NULL").unionByName(mark), "windows"), self.windows)

    def refresh(self, lines: DataFrame, months: Iterable[str] | None = None) -> list[str]:
        """Take the lines of these months (of all, if not given) anew from ``lines``, a table of ``dated_lines`` partitioned by month."""
        if months is None:
            months = [month for (month,) in touched(lines, MONTH)]
        months = sorted(months)
        if not months:
            return []
        new = settled(lines.where(F.col(MONTH).isin(months))).groupBy(MONTH, "day", "product_id").agg(F.sum("quantity").alias("sold"))
        held = self.days.read()
        old = new.where("false") if held is None else held.where(F.col(MONTH).isin(months))
        key = [MONTH, "day", "product_id"]
        both = new.select(*key, "sold", F.lit(0).cast("bigint").alias("before")).unionByName(
            old.select(*key, F.lit(0).cast("bigint").alias("sold"), F.col("sold").alias("before"))
        )
        merged = both.groupBy(*key).agg(F.coalesce(F.sum("sold"), F.lit(0)).alias("sold"), F.coalesce(F.sum("before"), F.lit(0)).alias("before"))
        merged = written_once(merged, "days")
        state = self._window_state()
        if state:
            as_of = state[1]
            changed = merged.where("sold <> before").select(
                "product_id",
                *(
                    F.when(F.col("day") >= F.lit(as_of - dt.timedelta(days=length)), F.col("sold") - F.col("before")).otherwise(F.lit(0)).alias(name)
                    for name, length in WINDOWS.items()
                ),
            )
            self._move(changed, as_of)
        self.days.replace(merged.select(*key, "sold"))
        return months

    def advance(self, as_of: dt.date | str) -> None:
        """Move the windows to a report date, later or earlier than the last one."""
        as_of = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
        state, held = self._window_state(), self.days.read()
        if held is None or (state and state[1] == as_of):
            return
        before = state[1] if state else None
        parts = []
        for name, length in WINDOWS.items():
            begin = as_of - dt.timedelta(days=length)
            if before is None:
                within, sign = F.col("day") >= F.lit(begin), 1
                first, last = begin, None
            else:
                old = before - dt.timedelta(days=length)
                first, last = min(begin, old), max(begin, old)
                within, sign = (F.col("day") >= F.lit(first)) & (F.col("day") < F.lit(last)), (-1 if begin > old else 1)
            pruned = F.col(MONTH) >= first.isoformat()[:7]
            if last is not None:
                pruned = pruned & (F.col(MONTH) <= last.isoformat()[:7])
            sums = [(F.col("sold") * (sign if other == name else 0)).alias(other) for other in WINDOWS]
            parts.append(held.where(pruned & within).select("product_id", *sums))
        self._move(parts[0].unionByName(parts[1]), as_of)

    def read(self) -> DataFrame | None:
        """What was sold of each product in both windows, as ``against_sales`` takes it; None before a report date was set."""
        state = self._window_state()
        return None if state is None else state[0].where("product_id IS NOT NULL").select("product_id", *WINDOWS)
