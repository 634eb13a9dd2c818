"""Tables that are kept up to date against the same built in one go, and what an update reads and writes."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartwheel.incremental import attribution
from cartwheel.incremental.attribution import Attribution
from cartwheel.incremental.buckets import BUCKET
from cartwheel.incremental.funnel import FunnelDays
from cartwheel.incremental.sales import MONTH, TrailingSales, month_of
from cartwheel.incremental.snapshots import Snapshot
from cartwheel.incremental.spending import Spending
from cartwheel.operators.versions import current_snapshot
from cartwheel.plans.attribution import channel_attribution
from cartwheel.plans.funnel import conversion_funnel
from cartwheel.plans.layers import load_curated
from cartwheel.plans.rfm import rfm_segmentation, segments
from cartwheel.plans.updates import update_curated
from cartwheel.sinks.watermarks import Watermarks

ORDERS = "order_id int, user_id int, order_date timestamp, total_amount decimal(15,2), status string, updated_at timestamp, _ingestion_ts timestamp"
START = dt.datetime(2024, 1, 1)


def order(number, user, day, amount, status, version, stamp=0):
    date = None if day is None else START + dt.timedelta(days=day)
    amount = None if amount is None else Decimal(amount)
    return (number, user, date, amount, status, START + dt.timedelta(hours=version), START + dt.timedelta(days=stamp))


def rows(df):
    return sorted(map(repr, df.collect()))


def written(folder):
    """Every data file with its time of change."""
    return {str(file): file.stat().st_mtime_ns for file in Path(folder).rglob("*.parquet")}


FIRST = [order(at, at % 7, at, at + 1, ("Paid", "Shipped", "Pending")[at % 3], 0) for at in range(40)]
SECOND = [
    order(0, 0, 0, 1, "Refunded", 1, 1),  # the first order of user 0 is taken back
    order(39, 4, 39, 40, "Paid", -1, 1),  # an older version
    order(37, 2, 50, 38, "Paid", 2, 1),  # another date
    order(41, 3, -5, 7, "Paid", 0, 1),  # a late order before the first
    order(3, 5, 3, 4, "Paid", 3, 1),  # another user
    order(42, None, 1, None, "Paid", 0, 1),
    order(42, None, 1, None, "Shipped", 0, 1),  # same version and stamp
    order(None, 1, 1, 1, "Paid", 0, 1),
]
THIRD = [
    order(41, 3, -5, 7, "Refunded", 4, 2),
    order(42, None, None, 9, "Paid", 5, 2),
    *(order(at, at % 7, at, at + 1, "Refunded", 9, 2) for at in range(40) if at % 7 == 6),  # nothing is left of user 6
]


@pytest.fixture
def batches(spark):
    return [spark.createDataFrame(part, ORDERS) for part in (FIRST, SECOND, THIRD)]


def test_snapshot_and_spending_follow_their_history(spark, folder, batches):
    users = spark.createDataFrame([(at, f"u{at}", f"e{at}", "A") for at in range(6)], "user_id int, full_name string, email string, loyalty_segment string")
    snapshot, spending, history = Snapshot(spark, f"{folder}/s", ["order_id"], buckets=8), Spending(spark, f"{folder}/m", buckets=4), None
    for batch in batches:
        changes = snapshot.apply(batch)
        history = batch if history is None else history.unionByName(batch)
        latest = current_snapshot(history.dropna(subset=["order_id"]), ["order_id"])
        assert rows(snapshot.read().select(*batch.columns)) == rows(latest)
        spending.apply(changes, snapshot.read())
        found = segments(spending.read(), users, as_of="2024-06-30")
        assert rows(found) == rows(rfm_segmentation(latest, users, as_of="2024-06-30"))
    assert rows(snapshot.apply(batches[1])) == [] and rows(snapshot.read().select(*batch.columns)) == rows(latest)
    snapshot.rebuild(history)
    assert rows(snapshot.read().select(*batch.columns)) == rows(latest)


def test_batches_may_come_in_any_order(spark, folder, batches):
    snapshot = Snapshot(spark, f"{folder}/s", ["order_id"], buckets=3)
    for batch in reversed(batches):
        snapshot.apply(batch)
    history = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert rows(snapshot.read().select(*history.columns)) == rows(current_snapshot(history.dropna(subset=["order_id"]), ["order_id"]))


def test_only_touched_buckets_are_read_and_written(spark, folder):
    """One row in a hundred is new; the files of all other buckets are taken away while it is merged."""
    snapshot = Snapshot(spark, f"{folder}/s", ["order_id"], buckets=64)
    base = spark.createDataFrame([order(at, 1, 1, at, "Paid", 0) for at in range(400)], ORDERS)
    snapshot.apply(base)
    before = written(f"{folder}/s")
    batch = spark.createDataFrame([order(at, 1, 1, 0, "Refunded", 1) for at in (5, 5, 77, 900, 901)], ORDERS)
    numbers = {r[0] for r in batch.select(F.pmod(F.xxhash64(F.col("order_id").cast("string")), F.lit(64))).distinct().collect()}
    untouched = [Path(name) for name in before if int(name.split(f"{BUCKET}=")[1].split("/")[0]) not in numbers]
    assert len(untouched) >= 50
    content = {file: file.read_bytes() for file in untouched}
    for file in untouched:
        file.write_bytes(b"not to be read")
    changes = snapshot.apply(batch)
    assert {r.order_id for r in changes.collect()} == {5, 77, 900, 901}
    for file, data in content.items():
        assert file.read_bytes() == b"not to be read"
        file.write_bytes(data)
    assert snapshot.read().count() == 402 and snapshot.read().where("status = 'Refunded'").count() == 4


def test_dates_are_looked_up_only_where_one_was_taken_back(spark, folder):
    snapshot, spending = Snapshot(spark, f"{folder}/s", ["order_id"]), Spending(spark, f"{folder}/m")
    first = [order(at, at % 10, at, 1, "Paid", 0) for at in range(100)]
    assert spending.apply(snapshot.apply(spark.createDataFrame(first, ORDERS)), snapshot.read()) == 0
    middle = [order(45, 5, 45, 1, "Refunded", 1), order(200, 3, 300, 1, "Paid", 0), order(46, 6, 46, 5, "Shipped", 1)]
    assert spending.apply(snapshot.apply(spark.createDataFrame(middle, ORDERS)), snapshot.read()) == 0
    assert spending.apply(snapshot.apply(spark.createDataFrame([order(2, 2, 2, 1, "Refunded", 1)], ORDERS)), snapshot.read()) == 1
    kept = {r.user_id: r for r in spending.read().collect()}
    assert kept[2].first_order_date == START + dt.timedelta(days=12) and kept[5].frequency == 9
    assert spending.apply(snapshot.apply(spark.createDataFrame([], ORDERS)), snapshot.read()) == 0


CLICKS = "event_id bigint, user_id int, event_type string, category_id int, channel_id int, event_time timestamp, day date"


def clicks(spark, count, offset=0, users=9, days=40):
    kinds = ("view", "add_to_cart", "purchase", "search")
    made = []
    for at in range(offset, offset + count):
        draw = at * 2654435761 % 2**32
        time = START + dt.timedelta(days=draw % days, minutes=draw // 64 % 1440 // 120 * 120)
        made.append((at, None if draw % 23 == 0 else draw // 7 % users - 2, kinds[draw // 3 % 4], None if draw % 11 == 0 else draw // 5 % 4, None if draw % 13 == 0 else draw // 17 % 5, time, time.date()))
    return spark.createDataFrame(made, CLICKS)


def test_funnel_of_days(spark, folder):
    categories = spark.createDataFrame([(at, f"c{at}") for at in range(4)], "category_id int, category_name string")
    events = clicks(spark, 600).withColumn("user_id", F.col("user_id") * 50_000)
    events.write.partitionBy("day").parquet(f"{folder}/clicks")
    stored, funnel = spark.read.schema(events.schema).parquet(f"{folder}/clicks"), FunnelDays(spark, f"{folder}/funnel")
    assert funnel.funnel(categories) is None
    early = stored.where("day < DATE '2024-01-20'")
    assert len(funnel.refresh(early, "day")) == 19
    assert rows(funnel.funnel(categories)) == rows(conversion_funnel(early, categories))
    kept = written(f"{folder}/funnel")
    for file in Path(f"{folder}/clicks").glob("day=2024-01-0*/*.parquet"):
        file.write_bytes(b"not to be read")
    assert len(funnel.refresh(stored, "day")) == 21  # their files are not read, nor those the funnel wrote
    assert rows(funnel.funnel(categories)) == rows(conversion_funnel(events, categories))
    assert kept.items() <= written(f"{folder}/funnel").items()
    assert funnel.refresh(stored, "day") == []


@pytest.mark.parametrize("lookback", [0, 3, 30])
def test_attribution_by_batches(spark, folder, lookback):
    """Three batches, the last with late events of all days."""
    channels = spark.createDataFrame([(at, f"c{at}", "t") for at in range(7)], "channel_id int, channel_name string, channel_type string")
    events = clicks(spark, 700)
    state = Attribution(spark, folder, buckets=3, lookback_days=lookback)
    late = F.col("event_id") % 9 == 0
    parts = [events.where(~late & (F.col("day") < "2024-01-25")), events.where(~late & (F.col("day") >= "2024-01-25")), events.where(late)]
    for number, part in enumerate(parts):
        assert state.add(part, f"b{number}") > 0
    expected = rows(channel_attribution(events, channels, lookback_days=lookback))
    assert rows(state.credits_of(channels)) == expected
    state.add(parts[2], "b2")  # once more
    assert rows(state.credits_of(channels)) == expected
    assert state.add(events.where("false"), "b3") == 0


def test_attribution_broadcasts_no_days(spark, folder, monkeypatch):
    """Customers' days, whose files are small, are sorted and not held by the driver."""
    plans, write = [], attribution.written_once

    def watched(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, purpose)

    monkeypatch.setattr(attribution, "written_once", watched)
    state, events = Attribution(spark, folder, buckets=2), clicks(spark, 300)
    for number in range(2):
        state.add(events.where(F.col("event_id") % 2 == number), str(number))
    assert len(plans) == 6 and any("SortMergeJoin" in plan for plan in plans)
    assert not any("BroadcastHashJoin" in plan for plan in plans)


def test_attribution_reads_and_writes_the_days_it_must(spark, folder):
    """Points out of every look-back and of other customers are taken away while a late touch is added."""
    channels = spark.createDataFrame([(at, f"c{at}", "t") for at in range(7)], "channel_id int, channel_name string, channel_type string")
    events = clicks(spark, 900, users=40, days=60)
    state = Attribution(spark, folder, buckets=8, lookback_days=5)
    state.add(events, "b0")
    buys = (F.col("event_type") == "purchase") & F.col("day").between(START + dt.timedelta(days=31), START + dt.timedelta(days=35))
    user = events.where(buys & F.col("user_id").isNotNull()).first().user_id
    new = spark.createDataFrame([(5000, user, "view", 1, 2, START + dt.timedelta(days=30, minutes=1), None)], CLICKS)
    (bucket,) = new.select(F.pmod(F.xxhash64(F.col("user_id").cast("string")), F.lit(8))).first()
    base = (START.date() - dt.date(1970, 1, 1)).days

    def needed(file: Path, first: int, last: int) -> bool:
        parts = dict(part.split("=") for part in file.parts if "=" in part)
        return int(parts[BUCKET]) == bucket and first <= int(parts["_day"]) - base <= last

    unread = [file for file in Path(f"{folder}/points").rglob("*.parquet") if not needed(file, 25, 35)]
    unread += [file for file in Path(f"{folder}/credits").rglob("*.parquet") if not needed(file, 30, 35)]
    content = {file: file.read_bytes() for file in unread}
    for file in content:
        file.write_bytes(b"not to be read")
    assert 0 < state.add(new, "b1") <= 6
    for file, data in content.items():
        assert file.read_bytes() == b"not to be read"
        file.write_bytes(data)
    whole = events.unionByName(new)
    assert rows(state.credits_of(channels)) == rows(channel_attribution(whole, channels, lookback_days=5))


def test_windows_move_and_take_changed_months(spark, folder):
    """Sums of both windows after moves to and fro, with lines that change, against a plain sum; other months are not read."""
    kinds = ("Paid", "Shipped", "Pending")
    made = [(at * 2654435761 % 7, dt.date(2022, 1, 1) + dt.timedelta(days=at * 40503 % 900), at % 5 + 1, kinds[at % 3]) for at in range(800)]
    lines = spark.createDataFrame(made, "product_id int, day date, quantity int, status string").withColumn(MONTH, month_of("day"))
    lines.write.partitionBy(MONTH).parquet(f"{folder}/lines")
    stored, sales = spark.read.schema(lines.schema).parquet(f"{folder}/lines"), TrailingSales(spark, f"{folder}/s")

    def expected(rows, as_of):
        found = {}
        for product, day, quantity, status in rows:
            if status != "Pending":
                own = found.setdefault(product, [0, 0])
                for at, length in enumerate((90, 365)):
                    own[at] += quantity if day >= as_of - dt.timedelta(days=length) else 0
        return {(product, *own) for product, own in found.items() if any(own)}

    def held():
        return {(r.product_id, r.sold_short, r.sold_long) for r in sales.read().collect() if r.sold_short or r.sold_long}

    assert sales.read() is None and len(sales.refresh(stored)) == 30
    for as_of in (dt.date(2023, 6, 1), dt.date(2023, 8, 20), dt.date(2023, 5, 11)):
        sales.advance(as_of)
        assert held() == expected(made, as_of)
    changed = [(p, d, q + 3, "Refunded" if q == 2 else s) if d.strftime("%Y-%m") in ("2023-04", "2022-07") else (p, d, q, s) for p, d, q, s in made]
    changed = [(p, d, q, "Pending" if s == "Refunded" else s) for p, d, q, s in changed]
    again = spark.createDataFrame(changed, "product_id int, day date, quantity int, status string").withColumn(MONTH, month_of("day"))
    for _ in range(2):
        sales.refresh(again, ["2023-04", "2022-07"])
        assert held() == expected(changed, dt.date(2023, 5, 11))
    for file in Path(f"{folder}/s/days").rglob("*.parquet"):
        if not any(f"{MONTH}={month}" in str(file) for month in ("2023-02", "2023-03", "2022-05", "2022-06")):
            file.write_bytes(b"not to be read")
    sales.advance(dt.date(2023, 6, 10))  # days of February and March, and of May and June the year before, leave the windows
    assert held() == expected(changed, dt.date(2023, 6, 10))


class Died(Exception):
    pass


@pytest.mark.parametrize("dies", [None, "merge", "add"])
def test_updated_marts_equal_rebuilt_ones(spark, folder, monkeypatch, dies):
    """Two runs of the raw and trusted layers; the update after the second one dies once, and rows arrive before it is repeated."""
    loads = [spark.createDataFrame(part, ORDERS) for part in (FIRST, SECOND, THIRD)]
    base = {
        "users": spark.createDataFrame([(at, f"u{at}", f"e{at}@x.org", "A", START) for at in range(7)], "user_id int, full_name string, email string, loyalty_segment string, updated_at timestamp"),
        "categories": spark.createDataFrame([(at, f"c{at}", START) for at in range(4)], "category_id int, category_name string, updated_at timestamp"),
        "marketing_channels": spark.createDataFrame([(at, f"c{at}", "t", START) for at in range(5)], "channel_id int, channel_name string, channel_type string, updated_at timestamp"),
    }
    events = clicks(spark, 400).drop("day").withColumn("updated_at", F.col("event_time"))
    state, marks = f"{folder}/states", Watermarks(spark, f"{folder}/marks")

    def arrive(number):
        stamp = f"2024-05-0{number + 1} 00:00:00.5"
        part = {"orders": loads[number].dropna(subset=["order_id"]).drop("_ingestion_ts"), "clickstream": events.where((F.col("event_id") % 3 == number) | (F.col("event_id") % 30 == 0))}
        for table, rows_of in (base | part if number == 0 else part).items():
            rows_of.withColumn("_ingestion_ts", F.lit(stamp).cast("timestamp")).withColumn("_ingestion_date", F.lit(stamp[:10])).write.mode(
                "append"
            ).partitionBy("_ingestion_date").parquet(f"{folder}/silver/{table}")

    def update():
        return update_curated(spark, f"{folder}/silver", state, f"{folder}/gold", marks, as_of="2024-06-30")

    arrive(0)
    assert len(update()) == 3
    arrive(1)
    if dies:
        owner = {"merge": Snapshot, "add": Attribution}[dies]
        with monkeypatch.context() as patch:
            patch.setattr(owner, dies, lambda *_: (_ for _ in ()).throw(Died()))
            with pytest.raises(Died):
                update()
    arrive(2)
    while "gold_q1_conversion_funnel" in update():
        pass
    load_curated(spark, f"{folder}/silver", f"{folder}/rebuilt", groups=("q1", "q2", "q5"), as_of="2024-06-30")
    for name in ("gold_q1_conversion_funnel", "gold_q2_rfm_segmentation", "gold_q5_attribution"):
        assert rows(spark.read.parquet(f"{folder}/gold/{name}")) == rows(spark.read.parquet(f"{folder}/rebuilt/{name}")), name
