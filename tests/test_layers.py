import datetime as dt
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartwheel import storage
from cartwheel.model import PRIMARY_KEYS, STAMP, STAMP_DATE
from cartwheel.operators.versions import restamp
from cartwheel.plans import layers
from cartwheel.session import scratch
from cartwheel.sinks import tables
from cartwheel.sinks.watermarks import START, Watermarks
from cartwheel.sources.files import changed_since, parquet, parquet_if_any

DAY = [dt.datetime(2024, 1, day, 1, 2, 3, 456789) for day in range(1, 10)]
CATEGORY = "category_id INT, category_name STRING, updated_at TIMESTAMP"


class Database:
    """Tables that change between runs, read as a source."""

    def __init__(self, spark):
        self.spark, self.rows, self.asked = spark, [], []

    def __call__(self, table, watermark):
        self.asked.append((table, watermark))
        df = self.spark.createDataFrame(self.rows, CATEGORY)
        return df if watermark is None else changed_since(df, "updated_at", watermark)


@pytest.fixture
def database(spark):
    return Database(spark)


@pytest.fixture
def watermarks(spark, folder):
    return Watermarks(spark, f"{folder}/state")


def names(df):
    return sorted(row.category_name for row in df.select("category_name").collect())


def test_watermarks(watermarks):
    assert watermarks.get("raw", "users") == START
    assert watermarks.of_layer("raw") == {}
    watermarks.put("raw", "users", "2024-01-01 00:00:00.5")
    watermarks.put("raw", "users", "2024-01-02 00:00:00")
    watermarks.put("trusted", "users", "2023-01-01 00:00:00")
    assert watermarks.get("raw", "users") == "2024-01-02 00:00:00"
    assert watermarks.of_layer("trusted") == {"users": "2023-01-01 00:00:00"}
    assert watermarks.get("raw", "orders") == START


def test_raw_is_incremental_and_idle_runs_write_nothing(spark, database, watermarks, folder):
    database.rows = [(1, "one", DAY[0]), (2, "two", DAY[1])]
    load = lambda: layers.load_raw(spark, database, f"{folder}/raw", ["categories"], watermarks)
    assert load() == ["categories"]
    assert watermarks.get("raw", "categories") == "2024-01-02 01:02:03.456789"
    assert load() == []
    assert parquet(spark, f"{folder}/raw/categories").count() == 2
    database.rows = [(1, "one", DAY[0]), (2, "two, changed", DAY[2]), (3, "three", DAY[1] + dt.timedelta(microseconds=1))]
    assert load() == ["categories"]
    assert names(parquet(spark, f"{folder}/raw/categories")) == ["one", "three", "two", "two, changed"]
    assert [asked for _, asked in database.asked][:2] == [START, "2024-01-02 01:02:03.456789"]


def test_untracked_tables_are_rewritten(spark, database, watermarks, folder):
    for rows in ([(1, "a", DAY[0]), (2, "b", DAY[0])], [(3, "c", DAY[0])]):
        database.rows = rows
        assert layers.load_raw(spark, database, f"{folder}/raw", ["notes"], watermarks) == ["notes"]
    assert names(parquet(spark, f"{folder}/raw/notes")) == ["c"]
    assert database.asked == [("notes", None), ("notes", None)]


def test_trusted_takes_new_batches_and_snapshot_takes_latest_rows(spark, database, watermarks, folder):
    raw, trusted = f"{folder}/raw", f"{folder}/trusted"

    def run(rows, raw_stamp, stamp):
        database.rows = rows
        layers.load_raw(spark, database, raw, ["categories"], watermarks, stamp=raw_stamp)
        return layers.load_trusted(spark, raw, trusted, ["categories", "missing"], watermarks, stamp=stamp)

    first = [(1, " one ", DAY[0]), (1, "one, later", DAY[1]), (2, "   ", DAY[0]), (None, "lost", DAY[0])]
    assert run(first, "2024-02-01 10:00:00.000001", "2024-02-01 11:00:00") == ["categories"]
    once = {(row.category_id, row.category_name) for row in parquet(spark, f"{trusted}/categories").collect()}
    assert once == {(1, "one, later"), (2, None)}
    single = layers.current(spark, trusted, ["categories"], f"{folder}/run1")["categories"]
    assert names(single.dropna()) == ["one, later"]

    assert run(first, "2024-02-02 10:00:00", "2024-02-02 11:00:00") == []
    assert run([(2, "two", DAY[3])], "2024-02-03 10:00:00", "2024-02-03 11:00:00") == ["categories"]
    history = parquet(spark, f"{trusted}/categories")
    assert history.count() == 3
    assert {str(row[STAMP_DATE]) for row in history.select(STAMP_DATE).distinct().collect()} == {"2024-02-01", "2024-02-03"}
    latest = layers.current(spark, trusted, ["categories"], f"{folder}/run2")["categories"]
    assert names(latest) == ["one, later", "two"]
    untouched = layers.current(spark, trusted, ["categories"], "", append_only=["categories"])["categories"]
    assert untouched.count() == 3


def test_failed_job_is_raised_and_leaves_the_watermark(spark, watermarks, folder):
    def source(table, watermark):
        raise RuntimeError("no connection")

    with pytest.raises(RuntimeError):
        layers.load_raw(spark, source, f"{folder}/raw", ["users", "orders"], watermarks)
    assert watermarks.get("raw", "users") == START


def test_changed_since(spark):
    df = restamp(spark.range(1), "2024-01-02 00:00:00.5")
    assert changed_since(df, STAMP, "2024-01-02 00:00:00.4").count() == 1
    assert changed_since(df, STAMP, "2024-01-02 00:00:00.5").count() == 0
    assert changed_since(df, STAMP, "2024-01-02 00:00:00.5", inclusive=True).count() == 1
    text = df.withColumn(STAMP, F.lit("2024-01-02 00:00:00"))
    assert changed_since(text, STAMP, "2024-01-01 23:59:59").count() == 1
    assert changed_since(text, STAMP, "2024-01-02 00:00:00").count() == 0


def test_changed_since_prunes_days(spark, folder):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        tables.append(restamp(spark.range(5), f"{day} 10:00:00"), f"{folder}/t", partition_by=(STAMP_DATE,))
    changed = changed_since(parquet(spark, f"{folder}/t"), STAMP, "2024-01-02 10:00:00")
    scan = changed._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({STAMP_DATE}" in scan
    assert f"PushedFilters: [IsNotNull({STAMP}), GreaterThan({STAMP}" in scan
    assert changed.count() == 5


def test_missing_input(spark, folder):
    assert parquet_if_any(spark, f"{folder}/nothing") is None


def test_replace_keeps_old_content_when_the_move_fails(spark, folder, monkeypatch):
    path = f"{folder}/t"
    tables.replace(spark.range(3), path)
    tables.replace(spark.range(4), path)
    assert parquet(spark, path).count() == 4
    real = storage.rename

    def rename(session, source, target):
        if ".staged-" in source:
            raise OSError("disk gone")
        real(session, source, target)

    monkeypatch.setattr(storage, "rename", rename)
    with pytest.raises(OSError):
        tables.replace(spark.range(9), path)
    assert parquet(spark, path).count() == 4


def test_replace_may_read_what_it_replaces(spark, folder):
    path = f"{folder}/t"
    tables.replace(spark.range(3), path)
    tables.replace(parquet(spark, path).union(spark.range(2)), path)
    assert parquet(spark, path).count() == 5


def test_single_partition_write(spark, folder):
    tables.write(spark.range(100).repartition(5), f"{folder}/t", "overwrite", single_partition=True)
    assert len(parquet(spark, f"{folder}/t").inputFiles()) == 1


def test_preview(spark, capsys):
    tables.preview(spark.range(3), "numbers", 0)
    assert capsys.readouterr().out == ""
    tables.preview(spark.range(3), "numbers", 2)
    assert "numbers" in capsys.readouterr().out


def session_with(settings, master):
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(f"{shared}/x-")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_scratch_without_shared_folder_is_for_local_sessions_only():
    assert "/x-" in scratch(session_with({}, "local[2]"), "x")
    with pytest.raises(ValueError):
        scratch(session_with({}, "spark://host:7077"), "x")


def test_curated_groups_and_rerun(spark, folder):
    trusted, curated = f"{folder}/trusted", f"{folder}/curated"
    users = spark.createDataFrame(
        [(1, "A", "a@x.org", "New")], "user_id INT, full_name STRING, email STRING, loyalty_segment STRING"
    )
    orders = spark.createDataFrame(
        [(1, 1, "Paid", dt.datetime(2024, 1, 1), Decimal(10))],
        "order_id INT, user_id INT, status STRING, order_date TIMESTAMP, total_amount DECIMAL(15,2)",
    )
    for table, df in (("users", users), ("orders", orders)):
        tables.append(restamp(df, "2024-02-01 00:00:00"), f"{trusted}/{table}", partition_by=(STAMP_DATE,))
    for _ in range(2):
        done = layers.load_curated(spark, trusted, curated, groups=["q2"], as_of="2024-01-11", preview_rows=1)
        assert done == ["gold_q2_rfm_segmentation"]
    (row,) = parquet(spark, f"{curated}/gold_q2_rfm_segmentation").collect()
    assert (row.recency_days, row.monetary) == (10, Decimal(10))
    again = orders.withColumn("total_amount", F.lit(99).cast("decimal(15,2)"))
    tables.append(restamp(again, "2024-02-02 00:00:00"), f"{trusted}/orders", partition_by=(STAMP_DATE,))
    layers.load_curated(spark, trusted, curated, groups=["q2"], as_of="2024-01-11")
    (row,) = parquet(spark, f"{curated}/gold_q2_rfm_segmentation").collect()
    assert (row.frequency, row.monetary) == (1, Decimal(99))
    layers.load_curated(spark, trusted, curated, groups=["q2"], as_of="2024-01-11", mode="append")
    assert parquet(spark, f"{curated}/gold_q2_rfm_segmentation").count() == 2
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("curated-*"))


def test_late_commits_are_found_with_an_overlap(spark, watermarks, folder):
    raw, trusted = f"{folder}/raw", f"{folder}/trusted"
    first = [(1, "one", DAY[2]), (2, "two", DAY[1])]
    late = [*first, (3, "same time", DAY[2]), (4, "older", DAY[1]), (2, "two, later", DAY[3])]
    schema = "category_id INT, category_name STRING, updated_at TIMESTAMP"

    def load(rows, stamp, **options):
        def source(table, watermark, inclusive=False):
            return changed_since(spark.createDataFrame(rows, schema), "updated_at", watermark, inclusive=inclusive)

        layers.load_raw(spark, source, raw, ["categories"], watermarks, stamp=stamp, **options)
        layers.load_trusted(spark, raw, trusted, ["categories"], watermarks, stamp=stamp)

    load(first, "2024-02-01 10:00:00")
    load(late, "2024-02-02 10:00:00", overlap=dt.timedelta(days=2))
    load(late, "2024-02-03 10:00:00", overlap=dt.timedelta(days=2))
    latest = layers.current(spark, trusted, ["categories"], f"{folder}/run")["categories"]
    found = sorted((row.category_id, row.category_name) for row in latest.collect())
    assert found == [(1, "one"), (2, "two, later"), (3, "same time"), (4, "older")]
    assert watermarks.get("raw", "categories") == str(DAY[3])


def test_trusted_loads_with_one_stamp_leave_each_key_once(spark, database, watermarks, folder):
    raw, trusted = f"{folder}/raw", f"{folder}/trusted"
    for name, day, raw_stamp in (("old", DAY[0], "2024-02-01 10:00:00"), ("new", DAY[1], "2024-02-02 10:00:00")):
        database.rows = [(1, name, day)]
        layers.load_raw(spark, database, raw, ["categories"], watermarks, stamp=raw_stamp)
        layers.load_trusted(spark, raw, trusted, ["categories"], watermarks, stamp="2024-02-05 00:00:00")
    assert parquet(spark, f"{trusted}/categories").count() == 2
    assert names(layers.current(spark, trusted, ["categories"], f"{folder}/run")["categories"]) == ["new"]


def test_missing_tables_are_empty_and_stop_no_output(spark, folder):
    orders = spark.createDataFrame(
        [(1, 1, "Paid", dt.datetime(2024, 1, 1), Decimal(10))],
        "order_id INT, user_id INT, status STRING, order_date TIMESTAMP, total_amount DECIMAL(15,2)",
    )
    tables.append(restamp(orders, "2024-02-01 00:00:00"), f"{folder}/t/orders", partition_by=(STAMP_DATE,))
    done = layers.load_curated(spark, f"{folder}/t", f"{folder}/c", groups=["q1", "q2", "q5"], as_of="2024-01-11")
    assert done == ["gold_q1_conversion_funnel", "gold_q2_rfm_segmentation", "gold_q5_attribution"]
    (row,) = parquet(spark, f"{folder}/c/gold_q2_rfm_segmentation").collect()
    assert (row.user_id, row.full_name) == (1, None)
    assert parquet(spark, f"{folder}/c/gold_q5_attribution").count() == 0
    for table in PRIMARY_KEYS:
        assert layers.no_rows(spark, table).count() == 0


def test_failing_output_stops_no_other_and_is_raised(spark, folder):
    users = spark.createDataFrame([(1, "A")], "user_id INT, unexpected STRING")
    orders = spark.createDataFrame([(1, 1, Decimal(1))], "order_id INT, user_id INT, total_amount DECIMAL(15,2)")
    promos = spark.createDataFrame([(1, "p")], "promo_id INT, promo_code STRING")
    channels = spark.createDataFrame(
        [(1, "c", "t", "p", "s", "m")],
        "channel_id INT, channel_name STRING, channel_type STRING, platform STRING, utm_source STRING, utm_medium STRING",
    )
    for table, df in (("users", users), ("orders", orders), ("promotions", promos), ("marketing_channels", channels)):
        tables.append(restamp(df, "2024-02-01 00:00:00"), f"{folder}/t/{table}", partition_by=(STAMP_DATE,))
    with pytest.raises(Exception) as raised:
        layers.load_curated(spark, f"{folder}/t", f"{folder}/c", groups=["dims"])
    assert any("dim_users" in note for note in raised.value.__notes__)
    assert parquet(spark, f"{folder}/c/dim_marketing_channels").count() == 1


def test_failed_write_leaves_nothing_beside_the_table(spark, folder):
    path = f"{folder}/t"
    tables.replace(spark.range(3), path)
    with pytest.raises(Exception):
        tables.replace(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert [p.name for p in Path(folder).iterdir()] == ["t"]
    assert parquet(spark, path).count() == 3
