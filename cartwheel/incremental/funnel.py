"""The conversion funnel from daily counts that are merged, so that old days are not read again.

Distinct users do not add up over days, but bitmaps of them do. For each arrival day and category, users who viewed and users who purchased are
marked in bitmaps, a block of 32,768 user numbers each; the blocks of all days are joined by OR and their bits counted.
The counts are exact. A block of one day and category is a row, so a popular category is spread over the blocks of its users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.incremental.buckets import PartitionedState, touched
from cartwheel.plans.funnel import rates

DAY = "_day"
# Events and the column that counts them; of those with a second name the users are counted as well.
KINDS = {"view": ("views", "viewers"), "add_to_cart": ("add_to_carts", None), "purchase": ("purchases", "purchasers")}


class FunnelDays:
    """Counts and user bitmaps of each arrival day, one partition a day.

    Events must not change once they arrived, and an event must arrive once: a bitmap cannot tell which events set a bit. User ids are whole numbers.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.state = PartitionedState(spark, path, [DAY])

    def days(self) -> list:
        """The days there are."""
        rows = self.state.read()
        return [] if rows is None else [day for (day,) in touched(rows, DAY)]

    def refresh(self, clicks: DataFrame, day: str, days: Sequence | None = None) -> list:
        """Count the given arrival days anew, or those there is nothing of yet; returns the days that were counted.

        ``day`` names the column of the arrival day. Where the events are partitioned by it, no other day's files are read.
        """
        if days is None:
            known = self.days()
            missing = clicks.where(F.col(day).isNotNull() & ~F.col(day).isin(known)) if known else clicks.where(F.col(day).isNotNull())
            days = [value for (value,) in touched(missing, day)]
        if not days:
            return []
        arrived = clicks.where(F.col(day).isin(list(days)))
        events = [F.count_if(F.col("event_type") == kind).alias(count) for kind, (count, _) in KINDS.items()]
        # A user's events of one category first, which are many fewer, and spread a popular category.
        per_user = arrived.groupBy(F.col(day).alias(DAY), "category_id", "user_id").agg(*events)
        marks = [
            F.bitmap_construct_agg(F.when(F.col(count) > 0, F.bitmap_bit_position("user_id"))).alias(users)
            for count, users in KINDS.values()
            if users
        ]
        block = F.bitmap_bucket_number("user_id").alias("block")
        sums = [F.sum(count).alias(count) for count, _ in KINDS.values()]
        self.state.replace(per_user.groupBy(DAY, "category_id", block).agg(*sums, *marks))
        return list(days)

    def funnel(self, categories: DataFrame) -> DataFrame | None:
        """The funnel of all days counted so far; None before the first."""
        rows = self.state.read()
        if rows is None:
            return None
        named = [(count, users) for count, users in KINDS.values()]
        blocks = rows.groupBy("category_id", "block").agg(
            *(F.sum(count).alias(count) for count, _ in named),
            *(F.bitmap_count(F.bitmap_or_agg(users)).alias(f"unique_{users}") for _, users in named if users),
        )
        # Events without a user are counted, but are nobody's.
        known = F.col("block").isNotNull()
        totals = blocks.groupBy("category_id").agg(
            *(F.sum(count).alias(count) for count, _ in named),
            *(F.coalesce(F.sum(F.when(known, F.col(f"unique_{users}"))), F.lit(0)).alias(f"unique_{users}") for _, users in named if users),
        )
        return rates(totals, categories)
