"""Purchases with the touches before them, joined while both stream in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.plans.attribution import LOOKBACK_DAYS, PURCHASE_EVENT, TOUCH_EVENTS
from cartwheel.sources import files
from cartwheel.streaming.clickstream import shape

LATE = "1 day"


def in_look_back(touched_at: Column, purchased_at: Column, lookback_days: int) -> Column:
    """Whether a touch counts for a purchase: before it, and not before midnight so many days earlier.

    The second bound is a plain interval beyond that midnight, which tells Spark when a touch can be forgotten.
    """
    midnight = F.date_trunc("day", purchased_at) - F.make_dt_interval(F.lit(lookback_days))
    reach = F.expr(f"INTERVAL {lookback_days + 1} DAYS")
    return (touched_at < purchased_at) & (touched_at >= midnight) & (touched_at >= purchased_at - reach)


def touched_purchases(
    clicks: DataFrame,
    *,
    lookback_days: int = LOOKBACK_DAYS,
    touch_events: Sequence[str] = TOUCH_EVENTS,
    purchase_event: str = PURCHASE_EVENT,
    late: str = LATE,
) -> DataFrame:
    """Each purchase with each touch of its look-back, from a stream (or a table) of shaped events.

    Both sides wait ``late`` for events that come out of order; what comes later than that is left out of the stream. A touch is kept until no purchase
    can reach back to it, a purchase until no touch before it can come, so the state is bounded by the look-back.
    """
    known = clicks.where(F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
    touches = known.where(F.col("event_type").isin(*touch_events)).select(
        F.col("user_id").alias("touch_user"), F.col("event_id").alias("touch_event"), F.col("event_time").alias("touched_at"), "channel_id"
    )
    purchases = known.where(F.col("event_type") == purchase_event).select(
        "user_id", F.col("event_id").alias("purchase_event"), F.col("event_time").alias("purchased_at")
    )
    near = in_look_back(F.col("touched_at"), F.col("purchased_at"), lookback_days)
    return (
        purchases.withWatermark("purchased_at", late)
        .join(touches.withWatermark("touched_at", late), (F.col("user_id") == F.col("touch_user")) & near)
        .drop("touch_user")
    )


def start(
    spark: SparkSession,
    input_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    lookback_days: int = LOOKBACK_DAYS,
    late: str = LATE,
    files_per_trigger: int | None = None,
    continuous: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Write the touches of each purchase to a Parquet table as click files come in; by default until all there are were taken."""
    clicks = files.click_file_stream(spark, input_path, files_per_trigger=files_per_trigger, glob="*.csv")
    pairs = touched_purchases(shape(clicks), lookback_days=lookback_days, late=late)
    writer = pairs.writeStream.format("parquet").outputMode("append").option("path", table_path)
    trigger = {"processingTime": interval} if continuous else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint_path).trigger(**trigger).start()
