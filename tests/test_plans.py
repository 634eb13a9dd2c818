"""The physical plans: what is read, how joins run, and how hot keys are split."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from cartwheel.plans.facts import fact_order_items
from cartwheel.plans.funnel import conversion_funnel
from cartwheel.plans.inventory import inventory_analysis
from cartwheel.plans.promotions import promo_comparison
from cartwheel.plans.transactions import user_transactions
from verification.queries import QUERIES, column_totals

JOBS = {  # these run while the query is built
    "clickstream_ingest", "clickstream_batch", "clickstream_continuous", "pipeline_run", "transactions_csv",
    "bronze_incremental_overlap", "raw_refresh", "snapshot_incremental", "q1_funnel_incremental", "q2_rfm_incremental",
    "q4_inventory_incremental", "q5_attribution_incremental", "clickstream_unique", "clickstream_touch_pairs",
    "fk_violations_by_bitmap", "key_violations_by_bitmap",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df, *, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in JOBS])
def test_no_query_joins_without_keys_or_leaves_the_jvm(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


def test_scans_read_needed_columns_only(spark, sf_dir):
    text = plan(QUERIES["q1_conversion_funnel"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(schemas) == ["event_id:bigint,user_id:bigint,event_type:string", "n_nationkey:int,n_name:string"]


def test_filters_reach_the_scan(spark, folder):
    orders = spark.range(10).selectExpr(
        "id AS order_id", "id AS user_id", "'Paid' AS status", "timestamp'2024-01-01' AS order_date",
        "CAST(1 AS DECIMAL(15,2)) AS total_amount", "'wide' AS shipping_address",
    )
    orders.write.parquet(f"{folder}/orders")
    items = spark.range(10).selectExpr("id AS order_id", "id AS product_id", "1 AS quantity")
    products = spark.range(10).selectExpr("id AS product_id", "'' product_name", "'' sku", "1.0 cost_price", "'' status")
    stock = spark.range(10).selectExpr("id AS product_id", "1 stock_on_hand", "1 reserved_quantity", "1 reorder_level")
    text = plan(inventory_analysis(products, stock, items, spark.read.parquet(f"{folder}/orders"), as_of="2024-02-01"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "In(status, [Paid,Shipped])" in scan and "GreaterThanOrEqual(order_date" in scan
    assert "shipping_address" not in scan


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


# Shuffles and scans of every query without any broadcast, those of the test views included.
SHUFFLES_AND_SCANS = {
    "user_transactions": (4, 3),  # users are a join of two tables themselves
    "bronze_incremental": (0, 1),
    "silver_clean": (0, 1),
    "silver_dedup": (1, 1),
    "silver_dedup_rare": (4, 4),
    "silver_distinct_rows": (1, 1),
    "silver_incremental": (1, 1),
    "current_snapshot": (2, 2),  # the two batches; the snapshot is partitioned as they are
    "dim_users": (2, 2),
    "dim_products": (2, 2),
    "dim_promotions": (1, 1),  # promotions and channels are derived by grouping
    "dim_marketing_channels": (1, 1),
    "fact_orders": (4, 3),
    "fact_order_items": (2, 2),  # lines and orders by order
    "q1_conversion_funnel": (3, 2),  # events per category and user, per category; categories
    "q2_rfm_segmentation": (4, 3),  # orders per user; users
    "q2_rfm_segmentation_raised": (4, 3),
    "q3_promo_comparison": (4, 2),
    "q3_promo_comparison_per_order": (4, 2),
    "q3_promo_detail": (5, 3),
    "q4_inventory_analysis": (6, 4),
    "q5_attribution": (9, 3),
    "q5_attribution_week": (9, 3),
    "order_totals_rollup": (2, 2),  # lines summed, orders
    "upsert_latest": (3, 5),  # base; incoming rows, once for their keys and once to rank them; each a union of two
    "insert_if_absent": (6, 9),
    "fk_violations": (8, 14),
    "fk_violations_text_keys": (5, 3),
    "key_violations": (17, 12),  # one scan for each of 11 relations, of which users read two tables
    "email_phone_quality": (0, 1),
}


def test_every_query_has_its_shuffles_counted():
    assert set(SHUFFLES_AND_SCANS) == set(QUERIES) - JOBS


@pytest.mark.parametrize("name", list(SHUFFLES_AND_SCANS))
def test_shuffles_without_any_broadcast(spark, sf_dir, name):
    with settings(spark, NO_BROADCAST):
        text = plan(QUERIES[name](spark, sf_dir))
    assert (text.count("Exchange hashpartitioning"), text.count("FileScan")) == SHUFFLES_AND_SCANS[name]


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "40",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
}


@pytest.fixture
def hot_orders(spark):
    """Lines of 20,000 orders, a third of them in one."""
    lines = spark.range(0, 150_000, numPartitions=12).selectExpr(
        "id AS order_item_id", "IF(id % 3 = 0, 7, id % 20000) AS order_id",
        "pmod(hash(id), 5000) AS product_id", "2 AS quantity",
        "1.0 AS unit_price", "rand(1) AS discount_amount", "rand(2) AS tax_amount", "rand(3) AS line_total",
    )
    orders = spark.range(20_000).selectExpr(
        "id AS order_id", "id AS user_id", "'Paid' AS status", "timestamp'2024-01-01' AS order_date"
    )
    return lines, orders


def test_order_with_a_third_of_all_lines_is_split(spark, hot_orders):
    lines, orders = hot_orders
    products = spark.range(5000).selectExpr("id AS product_id", "'' product_name", "'' sku", "1.0 cost_price", "'' status")
    stock = spark.range(5000).selectExpr("id AS product_id", "1 stock_on_hand", "1 reserved_quantity", "1 reorder_level")
    with settings(spark, SPLITTING):
        heads = fact_order_items(lines, orders)
        assert "skew=true" in plan(heads, final=True)
        assert heads.where("order_id = 7 AND user_id = 7").count() >= 50_000
        sold = inventory_analysis(products, stock, lines, orders, as_of="2024-01-02")
        assert "skew=true" in plan(sold, final=True)
        assert sold.agg(F.sum("qty_sold_90d")).first()[0] == 300_000


def test_hot_keys_are_counted_before_they_are_shuffled(spark):
    """Partial aggregates run below the first shuffle of each skewed input."""
    clicks = spark.range(1000).selectExpr(
        "IF(id % 3 = 0, 1, id) AS category_id", "id AS user_id", "'view' AS event_type"
    )
    categories = spark.range(5).selectExpr("id AS category_id", "'c' AS category_name")
    orders = spark.range(10).selectExpr("id AS order_id", "1.0 AS total_amount", "1.0 AS discount_amount")
    applied = spark.range(1000).selectExpr("IF(id % 3 = 0, 1, id) AS order_id", "id AS promo_id")
    users = spark.range(10).selectExpr("id AS user_id", "'r' AS region", "'n' AS name")
    spent = spark.range(1000).selectExpr("IF(id % 3 = 0, 1, id) AS user_id", "id AS transaction_id", "1.0 AS amount")
    for df in (
        conversion_funnel(clicks, categories),
        promo_comparison(orders, applied),
        user_transactions(users, spent),
    ):
        lines = plan(df).splitlines()
        below_shuffles = [lines[at + 1] for at, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert any("HashAggregate" in line and "partial_" in line for line in below_shuffles)


def test_totals_beyond_a_long(spark):
    """Three numbers of which each, but not their sum, is a long in ten-thousandths."""
    (row,) = column_totals(spark.createDataFrame([("900000000000000",)] * 3 + [("x",)], "phone string"), "users").collect()
    assert (row.column_name, row.filled, row.total, row.letters > 0) == ("phone", 4, 2.7e15, True)
