"""Marketing attribution from what each customer and day earned, of which new events change little.

Two tables are kept, both by day and by a hash of the customer. ``points`` hold touches per customer, instant and channel and the
instants of purchases. ``credits`` hold what each purchase day of a customer earned every channel. A new touch changes the credits of the purchases on
its day and in the look-back after it, a new purchase those of its own day. These customers' days are computed
again, from the points of their look-back; other partitions are neither read nor written. An event may arrive at any time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.incremental.buckets import BUCKET, PartitionedState, bucket_of, touched, written_once
from cartwheel.plans.attribution import LOOKBACK_DAYS, PURCHASE_EVENT, TOUCH_EVENTS, credited

BATCH, DAY = "_batch", "_day"
USER_DAY = (BUCKET, "user_id", DAY)


def _among(cells: Iterable[tuple[int, int]]) -> Column:
    """Whether a row lies in one of the (day, bucket) partitions; a filter on partition columns alone."""
    days: dict[int, list[int]] = {}
    for day, bucket in cells:
        days.setdefault(bucket, []).append(day)
    parts = [(F.col(BUCKET) == bucket) & F.col(DAY).isin(sorted(own)) for bucket, own in days.items()]
    return reduce(Column.__or__, parts, F.lit(False))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows that a join sorts and does not broadcast. Customers' days are written small and Spark goes by the size of their files, but
    in a broadcast they are many times as large, and the driver would hold all of them."""
    return rows.hint("merge")


class Attribution:
    """First-touch, last-touch and linear credit per channel, updated by batches of events.

    The same events must not come in two batches; a batch that is added again under its name takes the place of its first
    version, provided it covers the same days.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        buckets: int = 16,
        lookback_days: int = LOOKBACK_DAYS,
        touch_events: Sequence[str] = TOUCH_EVENTS,
        purchase_event: str = PURCHASE_EVENT,
    ) -> None:
        self.buckets, self.lookback = buckets, lookback_days
        self.touch_events, self.purchase_event = list(touch_events), purchase_event
        self.points = PartitionedState(spark, f"{path}/points", [BATCH, DAY, BUCKET])
        self.credits = PartitionedState(spark, f"{path}/credits", [DAY, BUCKET])

    def _points_of(self, clicks: DataFrame) -> DataFrame:
        buys = F.col("event_type") == self.purchase_event
        events = clicks.where(
            F.col("event_type").isin(*self.touch_events, self.purchase_event)
            & F.col("user_id").isNotNull()
            & F.col("event_time").isNotNull()
        ).select(
            "user_id",
            F.unix_date(F.to_date("event_time")).alias(DAY),
            F.col("event_time").alias("at"),
            buys.alias("buys"),
            F.when(~buys, F.col("channel_id")).alias("channel_id"),
            "event_id",
        )
        return (
            events.groupBy("user_id", DAY, "at", "buys", "channel_id")
            .agg(
                F.count_if(~F.col("buys")).alias("touches"),
                F.min("event_id").alias("first_event"),
                F.max("event_id").alias("last_event"),
            )
            .withColumn(BUCKET, bucket_of(["user_id"], self.buckets))
        )

    def add(self, clicks: DataFrame, batch: str) -> int:
        """Take in a batch of events; returns how many customers' days were computed again."""
        new = written_once(self._points_of(clicks), "points")
        cells = touched(new, DAY, BUCKET, "buys")
        if not cells:
            return 0
        self.points.replace(new.withColumn(BATCH, F.lit(batch)))
        ahead = F.when(F.col("buys"), 0).otherwise(self.lookback)
        reached = new.select(BUCKET, "user_id", F.explode(F.sequence(F.col(DAY), F.col(DAY) + ahead)).alias(DAY))
        to_judge = {(day + step, bucket) for day, bucket, buys in cells for step in range(1 if buys else self.lookback + 1)}
        to_read = {(day - step, bucket) for day, bucket in to_judge for step in range(self.lookback + 1)}

        stored = self.points.read()
        judged = stored.where(_among(to_judge) & F.col("buys")).select(*USER_DAY).distinct()
        days = written_once(judged.join(_sorted(reached.distinct()), list(USER_DAY), "left_semi"), "purchase-days")
        changed = days.count()
        if not changed:
            return 0
        earned = written_once(self._earned(stored.where(_among(to_read)), days), "credits")
        partitions = touched(days, DAY, BUCKET)
        held = self.credits.read()
        if held is not None:
            others = held.where(_among(partitions)).join(_sorted(days), list(USER_DAY), "left_anti")
            earned = others.select(*earned.columns).unionByName(earned)
        self.credits.replace(earned)
        return changed

    def _earned(self, points: DataFrame, days: DataFrame) -> DataFrame:
        """What every channel earned on the given purchase days, from the points of their look-backs."""
        users = days.select(BUCKET, "user_id").distinct()
        points = (
            points.join(_sorted(users), [BUCKET, "user_id"], "left_semi")
            .groupBy(*USER_DAY, "at", "buys", "channel_id")
            .agg(F.sum("touches").alias("touches"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))
        )

        def touch(event: str) -> Column:
            return F.when(~F.col("buys"), F.struct("at", F.col(event).alias("event_id"), "channel_id"))

        # The days of the look-back, as one row per day and channel.
        per_day = points.where(~F.col("buys")).groupBy(*USER_DAY, "channel_id").agg(
            F.sum("touches").alias("touches"), F.min(touch("first_event")).alias("first"), F.max(touch("last_event")).alias("last")
        )
        look_back = days.select(
            BUCKET, "user_id", F.col(DAY).alias("bought"), F.explode(F.sequence(F.col(DAY) - self.lookback, F.col(DAY))).alias(DAY)
        ).where(F.col(DAY) < F.col("bought"))
        per_channel = (
            look_back.join(_sorted(per_day), list(USER_DAY))
            .groupBy(BUCKET, "user_id", F.col("bought").alias(DAY), "channel_id")
            .agg(F.sum("touches").alias("touches"), F.min("first").alias("first"), F.max("last").alias("last"))
        )
        before_day = per_channel.groupBy(*USER_DAY).agg(
            F.sum("touches").alias("day_touches"), F.min("first").alias("day_first"), F.max("last").alias("day_last")
        )

        # The purchase day itself. At the same instant a purchase comes before the touches, which must not count for it.
        in_day = Window.partitionBy(*USER_DAY)
        earlier = in_day.orderBy("at", F.desc("buys")).rowsBetween(Window.unboundedPreceding, -1)
        later = in_day.orderBy(F.desc("at"), "buys").rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0)
        seen = (
            points.join(_sorted(days), list(USER_DAY), "left_semi")
            .join(_sorted(before_day), list(USER_DAY), "left")
            .withColumns(
                {
                    "own_touches": F.coalesce(F.sum("touches").over(earlier), zero),
                    "own_first": F.min(touch("first_event")).over(earlier),
                    "own_last": F.max(touch("last_event")).over(earlier),
                }
            )
            .withColumn("total", F.coalesce("day_touches", zero) + F.col("own_touches"))
            .withColumn("weight", F.when(F.col("buys") & (F.col("total") > 0), 1.0 / F.col("total")))
            .withColumn("due", F.coalesce(F.sum("weight").over(later), F.lit(0.0)))
        )

        def credit(channel: Column, first: Column = zero, last: Column = zero, linear: Column = F.lit(0.0)) -> Column:
            return F.struct(channel.alias("channel_id"), first.cast("bigint").alias("first"), last.cast("bigint").alias("last"), linear.alias("linear"))

        own = seen.select(
            *USER_DAY,
            F.inline(
                F.when(
                    F.col("weight").isNotNull(),
                    F.array(
                        credit(F.coalesce("day_first", "own_first")["channel_id"], first=F.lit(1)),
                        credit(F.coalesce("own_last", "day_last")["channel_id"], last=F.lit(1)),
                    ),
                ).when(~F.col("buys"), F.array(credit(F.col("channel_id"), linear=F.col("touches") * F.col("due"))))
            ),
        )
        weights = seen.where("weight IS NOT NULL").groupBy(*USER_DAY).agg(F.sum("weight").alias("weight"))
        from_look_back = per_channel.join(_sorted(weights), list(USER_DAY)).select(
            *USER_DAY, F.inline(F.array(credit(F.col("channel_id"), linear=F.col("touches") * F.col("weight"))))
        )
        return own.unionByName(from_look_back).groupBy(*USER_DAY, "channel_id").agg(
            *(F.sum(name).alias(name) for name in ("first", "last", "linear"))
        )

    def credits_of(self, channels: DataFrame) -> DataFrame | None:
        """All channels with what they earned so far; None before the first purchase with a touch."""
        rows = self.credits.read()
        if rows is None:
            return None
        return credited(channels, rows.groupBy("channel_id").agg(*(F.sum(name).alias(name) for name in ("first", "last", "linear"))))
