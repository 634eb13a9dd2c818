"""The layer jobs hold little on disk beside the tables they write."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartwheel import storage
from cartwheel.model import STAMP, STAMP_DATE
from cartwheel.operators.versions import restamp
from cartwheel.plans import layers
from cartwheel.plans.layers import GROUPS
from cartwheel.session import SHUFFLE_CLEANUP, shuffles_removed
from cartwheel.sinks import tables
from cartwheel.sinks.watermarks import Watermarks
from cartwheel.sources.files import parquet

STAMPED = "2024-02-01 00:00:00"


@pytest.fixture
def trusted(spark, folder):
    """Users, orders and lines, some orders in two versions."""
    money = {name: F.col("id").cast("decimal(15,2)") for name in ("total_amount", "subtotal_amount", "tax_amount", "discount_amount")}
    names = ("status", "payment_method", "payment_status", "source_channel", "device_type")
    orders = spark.range(40).select(
        F.col("id").alias("order_id"), (F.col("id") % 7).alias("user_id"),
        F.lit(dt.datetime(2024, 1, 1)).alias("order_date"), *(column.alias(name) for name, column in money.items()),
        F.col("id").cast("decimal(10,2)").alias("shipping_fee"), *(F.lit("Paid").alias(name) for name in names),
    )
    lines = spark.range(120).select(
        F.col("id").alias("order_item_id"), (F.col("id") % 40).alias("order_id"), (F.col("id") % 5).alias("product_id"),
        F.lit(2).alias("quantity"), *(F.col("id").cast("decimal(15,2)").alias(name) for name in ("unit_price", "discount_amount", "tax_amount", "line_total")),
    )
    users = spark.range(7).select(
        F.col("id").alias("user_id"), *(F.lit("x").alias(name) for name in ("full_name", "email", "loyalty_segment"))
    )
    for table, rows in (("orders", orders), ("order_items", lines), ("users", users)):
        tables.append(restamp(rows, STAMPED), f"{folder}/trusted/{table}", partition_by=(STAMP_DATE,))
    again = orders.where("order_id < 10").withColumn("status", F.lit("Refunded"))
    tables.append(restamp(again, "2024-02-02 00:00:00"), f"{folder}/trusted/orders", partition_by=(STAMP_DATE,))
    return f"{folder}/trusted"


def content(spark, path):
    return sorted(map(repr, parquet(spark, path).collect()))


def test_large_tables_one_by_one_and_no_longer_than_needed(spark, trusted, folder, monkeypatch):
    groups = ("facts", "q2")
    done = layers.load_curated(spark, trusted, f"{folder}/together", groups=groups, as_of="2024-01-11")
    shared, held, running = Path(spark.conf.get("spark.checkpoint.dir")), {}, []
    replace = tables.replace

    def watched(df, path, **options):
        running.append(path)
        held[path.rsplit("/", 1)[1]] = ({p.name for p in shared.glob("curated-*/*")}, len(running))
        replace(df, path, **options)
        running.remove(path)

    monkeypatch.setattr(tables, "replace", watched)
    monkeypatch.setattr(layers, "LARGE", 0, raising=False)
    assert layers.load_curated(spark, trusted, f"{folder}/alone", groups=groups, as_of="2024-01-11") == done
    assert held == {
        "fact_orders": ({"orders", "order_items"}, 1),
        "fact_order_items": ({"orders", "order_items"}, 1),
        "gold_q2_rfm_segmentation": ({"orders", "users"}, 1),
    }
    assert not list(shared.glob("curated-*"))
    for name in done:
        assert content(spark, f"{folder}/alone/{name}") == content(spark, f"{folder}/together/{name}"), name
    assert parquet(spark, f"{folder}/alone/fact_orders").where("status = 'Refunded'").count() == 10


def test_failing_large_output_stops_no_other(spark, trusted, folder, monkeypatch):
    tables.write(spark.range(3).withColumn(STAMP, F.lit(STAMPED).cast("timestamp")), f"{trusted}/users", "overwrite")
    monkeypatch.setattr(layers, "LARGE", 0, raising=False)
    with pytest.raises(Exception) as raised:
        layers.load_curated(spark, trusted, f"{folder}/c", groups=("q2", "facts"), as_of="2024-01-11")
    assert any("gold_q2_rfm_segmentation" in note for note in raised.value.__notes__)
    assert parquet(spark, f"{folder}/c/fact_order_items").count() == 120
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("curated-*"))


def test_append_only_tables_are_never_deleted(spark, trusted, folder, monkeypatch):
    monkeypatch.setattr(layers, "LARGE", 0, raising=False)
    layers.load_curated(spark, trusted, f"{folder}/c", groups=("facts",), append_only=("order_items",))
    assert parquet(spark, f"{folder}/c/fact_order_items").count() == 120
    assert parquet(spark, f"{trusted}/order_items").count() == 120


def test_every_output_of_large_tables_has_its_place():
    assert set(layers.ONE_BY_ONE) <= {name for group in GROUPS.values() for name in group}


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for at in folders for p in Path(at.getPath()).glob("*/shuffle_*")}


def test_jobs_leave_no_shuffle_files(spark, folder):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(1000).selectExpr("id % 300 AS category_id", "'x' AS category_name", "timestamp'2024-01-01' AS updated_at")
    watermarks = Watermarks(spark, f"{folder}/state")
    layers.load_raw(spark, lambda table, watermark: rows, f"{folder}/raw", ["categories"], watermarks)
    assert layers.load_trusted(spark, f"{folder}/raw", f"{folder}/trusted", ["categories"], watermarks) == ["categories"]
    assert parquet(spark, f"{folder}/trusted/categories").count() == 300
    until = time.time() + 20  # Spark removes them behind the scenes
    while len(left := {name.split("_")[1] for name in shuffle_files(spark) - before}) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(left) <= 1  # that of the count above
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_setting_is_restored_after_an_error(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    with pytest.raises(ValueError), shuffles_removed(spark), shuffles_removed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_size(spark, folder):
    assert storage.size(spark, f"{folder}/nothing") == 0
    tables.write(spark.range(1000), f"{folder}/t", "overwrite")
    written = [p for p in Path(f"{folder}/t").rglob("*.parquet")]
    assert all(".zstd." in p.name for p in written)
    assert storage.size(spark, f"{folder}/t") >= sum(p.stat().st_size for p in written) > 0


def test_click_files_are_deleted_only_if_told_so(spark, folder):
    line = "1,1,s,view,1,1,1,2024-01-01 00:00:00,,,,,,,,,1.0,0.0,True,null\n"
    for keep in (True, False):
        landing = Path(f"{folder}/landing-{keep}")
        landing.mkdir()
        (landing / "a.csv").write_text(line)
        counts = layers.run_pipeline(
            spark, None, f"{folder}/{keep}", click_path=str(landing), table_names=("clickstream",), groups=("q1",), keep_clicks=keep
        )
        assert ("silver", "clickstream", 1) in [tuple(row) for row in counts.collect()]
        assert landing.exists() == keep
