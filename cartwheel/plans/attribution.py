"""Marketing attribution: first touch, last touch and linear credit per channel.

A touch counts for a purchase when the same user made it before the purchase and
not earlier than midnight ``lookback_days`` before the purchase date. That bound
is a whole day, so the touches of a purchase are those of the days before it, all
of them, plus those earlier on its own day. Nothing here pairs touches with
purchases; each step is a running total over sorted rows:

1. Points: touches per user, instant and channel and purchases per user and
   instant, partitioned by user, day and a slot of some minutes. Copies of an event
   are merged before they are shuffled, and the points are computed once.
2. Slots: one row per user, day and slot. Running totals over the earlier slots of
   the day and over the days before give what came before each slot. Joined back
   to the points and added to the running totals inside the slot, they give the
   touches of each purchase; its weight is one over their number.
3. Backwards, the weights go to the touches: a touch earns those of the purchases
   after it in its slot, in later slots of its day and on the following days. The
   first is a running total over the points; the points are then summed per slot
   and channel, and running totals over those rows give the others.

The rows of one user are spread over days and slots, so a user with a large share
of all events fills many tasks. What is gathered per user are slots, whose number
is bounded by the calendar and not by the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The events that count as touches and as conversions, the look-back.
TOUCH_EVENTS = ("view", "add_to_cart")
PURCHASE_EVENT = "purchase"
LOOKBACK_DAYS = 30

SLOT_KEY = ("user_id", "day", "slot")
BEFORE = (Window.unboundedPreceding, -1)
WEIGHT = "decimal(30,15)"


def _slot(clickstream: DataFrame, time: str, minutes: int) -> Column:
    """A number that grows with time over a day, constant for ``minutes`` at a time."""
    if isinstance(clickstream.schema[time].dataType, T.TimestampNTZType):
        moment = F.hour(time) * 60 + F.minute(time)
    else:
        moment = F.unix_seconds(F.col(time)) / 60
    return F.floor(moment / minutes).cast("bigint")


def _points(
    clickstream: DataFrame, touch_events: Sequence[str], purchase_event: str, slot_minutes: int
) -> DataFrame:
    """Touches per user, instant and channel, and purchases per user and instant."""
    is_purchase = F.col("event_type") == purchase_event
    events = clickstream.where(
        F.col("event_type").isin(*touch_events, purchase_event)
        & F.col("user_id").isNotNull()
        & F.col("event_time").isNotNull()
    ).select(
        "user_id",
        F.unix_date(F.to_date("event_time")).alias("day"),
        _slot(clickstream, "event_time", slot_minutes).alias("slot"),
        F.col("event_time").alias("at"),
        is_purchase.alias("buys"),
        F.when(~is_purchase, F.col("channel_id")).alias("channel_id"),
        "event_id",
    )
    # Both uses of the points shuffle the same rows only if their filters agree, and a
    # join on the keys would add these conditions to one of them.
    complete = events.where(F.col("day").isNotNull() & F.col("slot").isNotNull())
    return (
        complete.groupBy(*SLOT_KEY, "at", "buys", "channel_id")
        .agg(
            F.count_if(~F.col("buys")).alias("touches"),
            F.min("event_id").alias("first_event"),
            F.max("event_id").alias("last_event"),
        )
        .repartition(*SLOT_KEY)
    )


def _touch(event: str) -> Column:
    """A touch as a value that sorts by time, ties by event id; NULL for a purchase."""
    return F.when(~F.col("buys"), F.struct("at", F.col(event).alias("event_id"), "channel_id"))


def _seen_before_slot(points: DataFrame, lookback_days: int) -> DataFrame:
    """Per slot: the touches on the days before and in the earlier slots of the day."""
    slots = points.groupBy(*SLOT_KEY).agg(
        F.sum("touches").alias("touches"),
        F.min(_touch("first_event")).alias("first"),
        F.max(_touch("last_event")).alias("last"),
    )
    earlier = Window.partitionBy("user_id", "day").orderBy("slot").rowsBetween(*BEFORE)
    # Frames that only grow are kept up to date row by row. So the days of the look-back are a difference of two
    # totals, and their first and last touch are those from its first day on and up to yesterday.
    by_day = Window.partitionBy("user_id").orderBy("day")
    to_yesterday = by_day.rangeBetween(*BEFORE)
    to_look_back = by_day.rangeBetween(Window.unboundedPreceding, -lookback_days - 1)
    from_look_back = (
        Window.partitionBy("user_id").orderBy(F.desc("day")).rangeBetween(Window.unboundedPreceding, lookback_days)
    )
    in_day = slots.repartition("user_id").withColumns(
        {
            "day_seen": F.sum("touches").over(earlier),
            "day_first": F.min("first").over(earlier),
            "day_last": F.max("last").over(earlier),
        }
    )
    days = in_day.withColumns(
        {
            "days_seen": _plus(F.sum("touches").over(to_yesterday)) - _plus(F.sum("touches").over(to_look_back)),
            "days_first": F.min("first").over(from_look_back),
            "days_last": F.max("last").over(to_yesterday),
        }
    )
    return days.select(
        *SLOT_KEY,
        _plus(F.col("days_seen"), F.col("day_seen")).alias("seen"),
        F.coalesce(F.when(_day_of("days_first") < F.col("day"), F.col("days_first")), "day_first").alias("first"),
        F.coalesce("day_last", F.when(_day_of("days_last") >= F.col("day") - lookback_days, F.col("days_last"))).alias("last"),
    )


def _day_of(touch: str) -> Column:
    return F.unix_date(F.to_date(F.col(touch)["at"]))


def _add_later_weights(per_slot: DataFrame, lookback_days: int) -> DataFrame:
    """Per slot and channel: what its touches earn from later slots of the day and the days after."""
    later = Window.partitionBy("user_id", "day").orderBy(F.desc("slot")).rangeBetween(*BEFORE)
    backwards = Window.partitionBy("user_id").orderBy(F.desc("day"))
    from_tomorrow = backwards.rangeBetween(*BEFORE)
    beyond = backwards.rangeBetween(Window.unboundedPreceding, -lookback_days - 1)
    exact = F.col("weight").cast(WEIGHT)  # a difference of sums of doubles would keep their rounding
    days_due = _plus(F.sum(exact).over(from_tomorrow)) - _plus(F.sum(exact).over(beyond))
    return (
        per_slot.repartition("user_id")
        .withColumn("day_due", F.sum("weight").over(later))
        .withColumn("due", _plus(F.col("day_due"), days_due.cast("double")))
        .withColumn("linear", F.col("linear") + F.col("touches") * F.col("due"))
    )


def _plus(*parts: Column) -> Column:
    total = F.coalesce(parts[0], F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(part, F.lit(0))
    return total


def _credit(channel: Column, **amounts: Column) -> Column:
    """What one point adds to a channel; amounts not given are 0."""
    none = F.lit(0)
    return F.struct(
        channel.alias("channel_id"),
        *(amounts.get(name, none).cast("bigint").alias(name) for name in ("first", "last", "touches")),
        *(amounts.get(name, none).cast("double").alias(name) for name in ("weight", "linear")),
    )


def channel_attribution(
    clickstream: DataFrame,
    channels: DataFrame,
    *,
    lookback_days: int = LOOKBACK_DAYS,
    touch_events: Sequence[str] = TOUCH_EVENTS,
    purchase_event: str = PURCHASE_EVENT,
    slot_minutes: int = 10,
) -> DataFrame:
    """Conversions credited to every channel, 0 where it earned none.

    Purchases are told apart by user and time; those without a touch earn no
    credit. Touches with an unknown or no channel take their share of the credit
    but show nowhere.
    """
    points = _points(clickstream, touch_events, purchase_event, slot_minutes)

    # At the same instant a purchase sorts before the touches, which must not count for it.
    in_slot = Window.partitionBy(*SLOT_KEY)
    forward = in_slot.orderBy("at", F.desc("buys")).rowsBetween(*BEFORE)
    backward = in_slot.orderBy(F.desc("at"), "buys").rowsBetween(*BEFORE)

    seen = points.withColumns(
        {
            "slot_seen": F.sum("touches").over(forward),
            "slot_first": F.min(_touch("first_event")).over(forward),
            "slot_last": F.max(_touch("last_event")).over(forward),
        }
    ).join(_seen_before_slot(points, lookback_days), list(SLOT_KEY))
    total = _plus(F.col("seen"), F.col("slot_seen"))
    weighed = seen.withColumn("weight", F.when(F.col("buys") & (total > 0), 1.0 / total)).withColumn(
        "slot_due", F.sum("weight").over(backward)
    )

    converts = F.col("weight").isNotNull()
    first, last = F.coalesce("first", "slot_first"), F.coalesce("slot_last", "last")
    earned = F.col("touches") * _plus(F.col("slot_due"))
    credits = weighed.select(
        *SLOT_KEY,
        F.inline(
            F.when(
                converts,
                F.array(
                    _credit(first["channel_id"], first=F.lit(1), weight=F.col("weight")),
                    _credit(last["channel_id"], last=F.lit(1)),
                ),
            ).when(
                ~F.col("buys"),
                F.array(_credit(F.col("channel_id"), touches=F.col("touches"), linear=earned)),
            )
        ),
    )
    per_slot = credits.groupBy(*SLOT_KEY, "channel_id").agg(
        *(F.sum(name).alias(name) for name in ("first", "last", "touches", "weight", "linear"))
    )
    per_channel = (
        _add_later_weights(per_slot, lookback_days)
        .groupBy("channel_id")
        .agg(*(F.sum(name).alias(name) for name in ("first", "last", "linear")))
    )
    return credited(channels, per_channel)


def credited(channels: DataFrame, per_channel: DataFrame) -> DataFrame:
    """All channels with what they earned, from sums per ``channel_id``."""
    return channels.select("channel_id", "channel_name", "channel_type").join(
        per_channel, "channel_id", "left"
    ).select(
        "channel_id", "channel_name", "channel_type",
        F.coalesce("first", F.lit(0)).alias("first_touch_conversions"),
        F.coalesce("last", F.lit(0)).alias("last_touch_conversions"),
        F.coalesce(F.round("linear", 2), F.lit(0.0)).alias("linear_conversions"),
    )
