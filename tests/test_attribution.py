"""Attribution against every touch and purchase pair, and on a user with a third of all events."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.plans.attribution import channel_attribution

SCHEMA = "event_id BIGINT, user_id INT, event_type STRING, channel_id INT, event_time TIMESTAMP"
BOUGHT = dt.datetime(2024, 3, 15, 12, 34, 56)
MIDNIGHT = dt.datetime(2024, 2, 14)


def channels(spark, count=4):
    return spark.range(1, count + 1).selectExpr(
        "CAST(id AS INT) AS channel_id", "'c' || id AS channel_name", "'Paid' AS channel_type"
    )


def credits(spark, events, **options):
    df = spark.createDataFrame(events, SCHEMA) if isinstance(events, list) else events
    found = channel_attribution(df, channels(spark), **options).collect()
    return {
        row.channel_id: (row.first_touch_conversions, row.last_touch_conversions, row.linear_conversions)
        for row in found
    }


def expected(events, lookback=30, count=4):
    touches, purchases = defaultdict(list), set()
    for event_id, user, kind, channel, at in events:
        if user is None or at is None:
            continue
        if kind in ("view", "add_to_cart"):
            touches[user].append((at, event_id, channel))
        elif kind == "purchase":
            purchases.add((user, at))
    sums = defaultdict(lambda: [0, 0, 0.0])
    for user, bought in purchases:
        start = dt.datetime.combine(bought.date() - dt.timedelta(days=lookback), dt.time())
        seen = sorted(touch for touch in touches[user] if start <= touch[0] < bought)
        if seen:
            sums[seen[0][2]][0] += 1
            sums[seen[-1][2]][1] += 1
            for touch in seen:
                sums[touch[2]][2] += 1 / len(seen)
    return {channel: (sums[channel][0], sums[channel][1], pytest.approx(sums[channel][2], abs=0.0051))
            for channel in range(1, count + 1)}


def test_window_bounds(spark):
    second = dt.timedelta(seconds=1)
    events = [
        (1, 1, "view", 1, MIDNIGHT - second),
        (2, 1, "view", 2, MIDNIGHT),
        (3, 1, "view", 3, BOUGHT - second),
        (4, 1, "view", 4, BOUGHT),
        (5, 1, "purchase", 4, BOUGHT),
        (6, 1, "view", 4, BOUGHT + second),
    ]
    assert credits(spark, events) == {1: (0, 0, 0.0), 2: (1, 0, 0.5), 3: (0, 1, 0.5), 4: (0, 0, 0.0)}


def test_two_purchases_share_touches(spark):
    hour = dt.timedelta(hours=1)
    events = [
        (1, 1, "view", 1, BOUGHT - 2 * hour),
        (2, 1, "purchase", None, BOUGHT - hour),
        (3, 1, "add_to_cart", 2, BOUGHT - hour / 2),
        (4, 1, "purchase", None, BOUGHT),
        (5, 1, "purchase", None, BOUGHT),
    ]
    assert credits(spark, events)[1] == (2, 1, 1.5)
    assert credits(spark, events)[2] == (0, 1, 0.5)


def test_lost_credit(spark):
    minute = dt.timedelta(minutes=1)
    events = [
        (1, 1, "view", None, BOUGHT - 3 * minute),
        (2, 1, "view", 77, BOUGHT - 2 * minute),
        (3, 1, "view", 1, BOUGHT - minute),
        (4, 1, "purchase", 1, BOUGHT),
        (5, 2, "purchase", 1, BOUGHT),
        (6, None, "view", 2, BOUGHT - minute),
        (7, None, "purchase", 2, BOUGHT),
        (8, 1, "view", 2, None),
    ]
    assert credits(spark, events) == {1: (0, 1, 0.33), 2: (0, 0, 0.0), 3: (0, 0, 0.0), 4: (0, 0, 0.0)}


def test_ties_fall_to_event_id(spark):
    at = BOUGHT - dt.timedelta(days=1)
    events = [(2, 1, "view", 2, at), (1, 1, "view", 1, at), (3, 1, "view", 3, at), (9, 1, "purchase", None, BOUGHT)]
    assert credits(spark, events)[1] == (1, 0, 0.33)
    assert credits(spark, events)[3] == (0, 1, 0.33)


def random_events(seed, users, count, days, step):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    kinds = ["view"] * 5 + ["add_to_cart"] * 2 + ["purchase"] * 2 + ["signup"]
    return [
        (
            i,
            rng.choice([None, *range(users)]) if rng.random() < 0.05 else rng.randrange(users),
            rng.choice(kinds),
            rng.choice([None, 1, 2, 3, 77]),
            start + dt.timedelta(microseconds=rng.randrange(days * 86_400_000_000 // step) * step),
        )
        for i in range(count)
    ]


@pytest.mark.parametrize(
    "seed, users, count, days, step, options",
    [
        (1, 5, 400, 90, 1, {}),
        (2, 3, 500, 2, 1_000_000, {}),
        (3, 2, 300, 1, 60_000_000, {"slot_minutes": 1}),
        (4, 4, 500, 60, 3_600_000_000, {"lookback_days": 3, "slot_minutes": 60}),
        (5, 1, 300, 40, 1, {"lookback_days": 1, "slot_minutes": 7}),
        (6, 3, 300, 3, 1_000_000, {"lookback_days": 0}),
    ],
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_equals_all_pairs(spark, seed, users, count, days, step, options, kind):
    events = random_events(seed, users, count, days, step)
    df = spark.createDataFrame(events, SCHEMA).withColumn("event_time", F.col("event_time").cast(kind))
    assert credits(spark, df, **options) == expected(events, options.get("lookback_days", 30))


def test_user_with_a_third_of_all_events(spark):
    """Two million events: pairs of the large user alone would number tens of billions."""
    at = F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id") % 2_592_000)
    events = spark.range(2_000_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50_000).cast("int").alias("user_id"),
        F.when(F.col("id") % 10 == 0, "purchase").otherwise("view").alias("event_type"),
        (1 + F.col("id") % 4).cast("int").alias("channel_id"),
        at.alias("event_time"),
    )
    found = credits(spark, events)
    of_hot = events.where("user_id = 0 AND event_type = 'purchase'").select("event_time").distinct().count()
    assert of_hot > 60_000
    total_first = sum(first for first, _, _ in found.values())
    assert total_first == sum(last for _, last, _ in found.values())
    assert total_first == pytest.approx(sum(linear for _, _, linear in found.values()), abs=0.05)
    assert total_first >= of_hot - 1


def test_events_are_read_and_shuffled_once(spark, folder):
    spark.createDataFrame(random_events(7, 3, 100, 5, 1), SCHEMA).write.parquet(f"{folder}/clicks")
    found = channel_attribution(spark.read.parquet(f"{folder}/clicks"), channels(spark))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan
