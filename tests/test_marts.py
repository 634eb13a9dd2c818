import datetime as dt
from decimal import Decimal

import pytest

from cartwheel.plans.dims import dim_products
from cartwheel.plans.facts import fact_order_items, fact_orders
from cartwheel.plans.funnel import conversion_funnel
from cartwheel.plans.inventory import inventory_analysis
from cartwheel.plans.promotions import promo_comparison, promo_detail
from cartwheel.plans.rfm import rfm_segmentation
from cartwheel.plans.transactions import user_transactions
from cartwheel.operators.rollup import order_totals_rollup

TODAY = dt.date(2024, 6, 30)


def ago(days, hour=12):
    return dt.datetime(TODAY.year, TODAY.month, TODAY.day, hour) - dt.timedelta(days=days)


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_user_transactions_golden(spark):
    users = spark.createDataFrame(
        [(1, "HN", "A"), (2, "HCM", "B"), (3, "HN", "C"), (4, "DN", "D"), (5, "DN", "without")],
        "user_id INT, region STRING, name STRING",
    )
    transactions = spark.createDataFrame(
        [(1001, 1, 120000), (1002, 1, 150000), (1003, 2, 200000), (1004, 3, 80000),
         (1005, 3, 95000), (1006, 2, 50000), (1007, 4, 65000), (1008, None, 1), (1009, 9, 1)],
        "transaction_id INT, user_id INT, amount INT",
    )
    found = {tuple(row) for row in user_transactions(users, transactions).collect()}
    assert found == {
        ("HN", 1, "A", 2, 270000, 135000.0),
        ("HCM", 2, "B", 2, 250000, 125000.0),
        ("HN", 3, "C", 2, 175000, 87500.0),
        ("DN", 4, "D", 1, 65000, 65000.0),
    }


def test_user_transactions_keeps_repeated_users_and_missing_amounts(spark):
    users = spark.createDataFrame([(1, "HN", "A"), (1, "HN", "A")], "user_id INT, region STRING, name STRING")
    transactions = spark.createDataFrame(
        [(1, 1, Decimal("1.00")), (2, 1, None), (3, 1, Decimal("2.00"))],
        "transaction_id INT, user_id INT, amount DECIMAL(15,2)",
    )
    (row,) = user_transactions(users, transactions).collect()
    assert tuple(row)[3:] == (6, Decimal("6.00"), Decimal("1.500000"))


def test_funnel(spark):
    events = [
        (1, 10, "view"), (1, 10, "view"), (1, 11, "view"), (1, 10, "add_to_cart"), (1, 10, "purchase"),
        (1, None, "view"), (2, 10, "add_to_cart"), (None, 12, "view"), (9, 12, "purchase"), (1, 11, "signup"),
    ]
    clicks = spark.createDataFrame(events, "category_id INT, user_id INT, event_type STRING")
    categories = spark.createDataFrame([(1, "one"), (2, "two"), (3, "unseen")], "category_id INT, category_name STRING")
    found = by_key(conversion_funnel(clicks, categories), "category_id")
    assert set(found) == {1, 2, None, 9}
    assert tuple(found[1])[1:] == ("one", 4, 1, 1, 2, 1, 25.0, 100.0, 25.0)
    assert tuple(found[2])[1:] == ("two", 0, 1, 0, 0, 0, 0.0, 0.0, 0.0)
    assert tuple(found[None])[1:] == (None, 1, 0, 0, 1, 0, 0.0, 0.0, 0.0)
    assert tuple(found[9])[1:] == (None, 0, 0, 1, 0, 1, 0.0, 0.0, 0.0)


ORDER = "order_id INT, user_id INT, status STRING, order_date TIMESTAMP, total_amount DECIMAL(15,2)"
USER = "user_id INT, full_name STRING, email STRING, loyalty_segment STRING"


def rfm_of(spark, orders):
    users = spark.createDataFrame([(1, "A", "a@x.org", "New")], USER)
    return rfm_segmentation(spark.createDataFrame(orders, ORDER), users, as_of=TODAY)


@pytest.mark.parametrize("days, score", [(30, 5), (31, 4), (60, 4), (61, 3), (90, 3), (91, 2), (180, 2), (181, 1)])
def test_recency_bounds(spark, days, score):
    (row,) = rfm_of(spark, [(1, 1, "Paid", ago(days, hour=23), Decimal(1))]).collect()
    assert (row.recency_days, row.r_score) == (days, score)


@pytest.mark.parametrize("count, score", [(1, 1), (2, 2), (3, 3), (4, 3), (5, 4), (9, 4), (10, 5)])
def test_frequency_bounds(spark, count, score):
    orders = [(i, 1, "Shipped", ago(1), Decimal(1)) for i in range(count)] + [(99, 1, "Pending", ago(1), Decimal(1))]
    (row,) = rfm_of(spark, orders).collect()
    assert (row.frequency, row.f_score) == (count, score)


@pytest.mark.parametrize(
    "amount, score",
    [("99.99", 1), ("100", 2), ("199.99", 2), ("200", 3), ("499.99", 3), ("500", 4), ("999.99", 4), ("1000", 5)],
)
def test_monetary_bounds(spark, amount, score):
    (row,) = rfm_of(spark, [(1, 1, "Paid", ago(1), Decimal(amount))]).collect()
    assert (row.monetary, row.m_score) == (Decimal(amount), score)


@pytest.mark.parametrize(
    "count, days, amount, segment",
    [
        (10, 1, 100, "VIP"),
        (5, 40, 50, "Loyal"),
        (2, 1, 1, "Potential"),
        (3, 200, 10, "At Risk"),
        (1, 200, 10, "Churn Risk"),
        (1, 60, 10, "New/Casual"),
    ],
)
def test_segments(spark, count, days, amount, segment):
    orders = [(i, 1, "Paid", ago(days), Decimal(amount)) for i in range(count)]
    (row,) = rfm_of(spark, orders).collect()
    assert row.customer_segment == segment


def test_rfm_keeps_unknown_and_missing_users(spark):
    found = by_key(
        rfm_of(spark, [(1, None, "Paid", ago(1), Decimal(1)), (2, 7, "Paid", ago(1), Decimal(1)),
                       (3, 1, "Cancelled", ago(1), Decimal(1))]),
        "user_id",
    )
    assert set(found) == {None, 7}
    assert found[7].full_name is None


@pytest.fixture
def promo_tables(spark):
    orders = spark.createDataFrame(
        [(1, Decimal(100), Decimal(5)), (2, Decimal(200), None), (3, Decimal(50), Decimal(1)),
         (4, None, Decimal(2)), (5, Decimal(10), Decimal(0))],
        "order_id INT, total_amount DECIMAL(15,2), discount_amount DECIMAL(15,2)",
    )
    applied = spark.createDataFrame(
        [(1, 7, Decimal("3.00")), (1, 8, Decimal("0.00")), (3, 7, Decimal("4.00")), (4, 9, None),
         (5, None, Decimal("9.00")), (99, 7, Decimal("1.00"))],
        "order_id INT, promo_id INT, applied_amount DECIMAL(15,2)",
    )
    promotions = spark.createDataFrame(
        [(7, "SEVEN", Decimal(5), "c"), (8, "EIGHT", None, "c")],
        "promo_id INT, promo_code STRING, discount_percent DECIMAL(5,2), campaign_name STRING",
    )
    return orders, applied, promotions


def test_promo_comparison_counts_an_order_per_promotion(promo_tables):
    orders, applied, _ = promo_tables
    found = by_key(promo_comparison(orders, applied), "has_promotion")
    assert tuple(found[True])[1:] == (4, Decimal(250), Decimal("83.333333"), Decimal(13), Decimal("3.250000"))
    assert tuple(found[False])[1:] == (2, Decimal(210), Decimal(105), Decimal(0), Decimal(0))


def test_promo_comparison_per_order(promo_tables):
    orders, applied, _ = promo_tables
    found = by_key(promo_comparison(orders, applied, per_order=True), "has_promotion")
    assert (found[True].num_orders, found[True].total_revenue) == (3, Decimal(150))
    assert (found[False].num_orders, found[False].total_revenue) == (2, Decimal(210))


def test_promo_detail(promo_tables):
    found = by_key(promo_detail(*promo_tables), "promo_id")
    assert set(found) == {7, 8, 9}
    assert tuple(found[7])[1:] == (
        "SEVEN", Decimal(5), "c", 2, Decimal(150), Decimal(75), Decimal(7), Decimal("21.43"),
    )
    assert found[8].revenue_per_discount is None
    assert (found[9].promo_code, found[9].times_used, found[9].total_revenue) == (None, 1, None)


def test_inventory(spark):
    products = spark.createDataFrame(
        [(1, Decimal(10)), (2, Decimal(10)), (3, None), (4, Decimal(10)), (5, Decimal(10)), (6, Decimal(10))],
        "product_id INT, cost_price DECIMAL(15,2)",
    ).selectExpr("product_id", "'p' AS product_name", "'s' AS sku", "cost_price", "'active' AS status")
    inventory = spark.createDataFrame(
        [(1, 100, 10, 20), (1, 50, None, 40), (2, 5, 9, 1), (3, 50, 0, 10), (4, 30, 0, 31), (5, 90, 0, 1)],
        "product_id INT, stock_on_hand INT, reserved_quantity INT, reorder_level INT",
    )
    orders = spark.createDataFrame(
        [(1, "Paid", ago(90, hour=0)), (2, "Shipped", ago(91)), (3, "Pending", ago(1)),
         (4, "Paid", ago(365, hour=0)), (5, "Paid", ago(366))],
        "order_id INT, status STRING, order_date TIMESTAMP",
    )
    items = spark.createDataFrame(
        [(1, 1, 9), (2, 1, 100), (3, 1, 1000), (4, 1, 1), (5, 1, 5000), (1, 3, 45), (2, 5, 182), (99, 1, 7)],
        "order_id INT, product_id INT, quantity INT",
    )
    found = by_key(inventory_analysis(products, inventory, items, orders, as_of=TODAY), "product_id")
    one = found[1]
    assert (one.qty_sold_90d, one.qty_sold_365d, one.total_stock, one.available_stock) == (9, 110, 150, 140)
    assert (one.avg_reorder_level, one.daily_sales_rate, one.days_of_stock) == (30.0, 0.1, 1400.0)
    assert (one.dsi, one.inventory_status) == (Decimal("497.7"), "Slow Moving")
    assert found[2].inventory_status == "Out of Stock"
    assert (found[3].dsi, found[3].daily_sales_rate, found[3].inventory_status) == (None, 0.5, "Healthy")
    assert found[4].inventory_status == "Low Stock"
    assert (found[5].dsi, found[5].inventory_status) == (Decimal("180.5"), "Slow Moving")
    assert (found[6].total_stock, found[6].inventory_status, found[6].days_of_stock) == (0, "Out of Stock", None)


@pytest.mark.parametrize("sold, status", [(365, "Healthy"), (364, "Moderate"), (183, "Moderate"), (182, "Slow Moving")])
def test_days_of_inventory_bounds(spark, sold, status):
    products = spark.sql("SELECT 1 product_id, 'p' product_name, 's' sku, CAST(10 AS DECIMAL(15,2)) cost_price, 'x' status")
    inventory = spark.sql("SELECT 1 product_id, 90 stock_on_hand, 0 reserved_quantity, 1 reorder_level")
    orders = spark.createDataFrame([(1, "Paid", ago(100))], "order_id INT, status STRING, order_date TIMESTAMP")
    items = spark.createDataFrame([(1, 1, sold)], "order_id INT, product_id INT, quantity INT")
    (row,) = inventory_analysis(products, inventory, items, orders, as_of=TODAY).collect()
    assert row.inventory_status == status


def test_facts(spark):
    orders = spark.createDataFrame([(1, 5, ago(3)), (2, 6, ago(4))], "order_id INT, user_id INT, order_date TIMESTAMP")
    for name in ("total_amount", "subtotal_amount", "tax_amount", "shipping_fee", "discount_amount"):
        orders = orders.selectExpr("*", f"CAST(1 AS DECIMAL(15,2)) AS {name}")
    for name in ("status", "payment_method", "payment_status", "source_channel", "device_type"):
        orders = orders.selectExpr("*", f"'x' AS {name}")
    items = spark.createDataFrame(
        [(11, 1, 3, 2), (12, 1, 4, None), (13, 77, 4, 1)],
        "order_item_id INT, order_id INT, product_id INT, quantity INT",
    )
    for name in ("unit_price", "discount_amount", "tax_amount", "line_total"):
        items = items.selectExpr("*", f"CAST(1 AS DECIMAL(15,2)) AS {name}")
    promos = spark.createDataFrame([(1, 7, Decimal(3)), (1, 8, Decimal(4))],
                                   "order_id INT, promo_id INT, applied_amount DECIMAL(15,2)")
    found = by_key(fact_orders(orders, items, promos), "order_id")
    assert (found[1].total_quantity, found[1].num_line_items) == (2, 2)
    assert (found[1].promo_discount_total, found[1].num_promos_applied) == (Decimal(7), 2)
    assert (found[2].total_quantity, found[2].num_line_items) == (0, 0)
    assert (found[2].promo_discount_total, found[2].num_promos_applied) == (Decimal(0), 0)
    lines = by_key(fact_order_items(items, orders), "order_item_id")
    assert (lines[11].user_id, lines[11].order_date_key) == (5, ago(3).date())
    assert (lines[13].user_id, lines[13].order_date) == (None, None)


def test_dim_products_keeps_unknown_categories(spark):
    products = spark.sql(
        "SELECT id AS product_id, 'p' product_name, 's' sku, id AS category_id, 'b' brand, 1 base_price, 1 cost_price, "
        "'active' status, current_timestamp() created_at FROM range(2)"
    )
    categories = spark.createDataFrame([(0, "zero")], "category_id INT, category_name STRING")
    found = by_key(dim_products(products, categories), "product_id")
    assert (found[0].category_name, found[1].category_name) == ("zero", None)


def test_rollup(spark):
    orders = spark.createDataFrame(
        [(1, *[Decimal(9)] * 5), (2, *[Decimal(9)] * 5), (3, *[Decimal(9)] * 3, None, Decimal(9))],
        "order_id INT, total_amount DECIMAL(15,2), subtotal_amount DECIMAL(15,2), tax_amount DECIMAL(15,2), "
        "shipping_fee DECIMAL(10,2), discount_amount DECIMAL(15,2)",
    )
    items = spark.createDataFrame(
        [(1, 2, Decimal(10), Decimal(1), Decimal(2)), (1, 1, Decimal(5), None, Decimal(1)),
         (3, 1, Decimal(5), Decimal(1), Decimal(1)), (4, 1, Decimal(5), Decimal(1), Decimal(1))],
        "order_id INT, quantity INT, unit_price DECIMAL(15,2), tax_amount DECIMAL(15,2), discount_amount DECIMAL(15,2)",
    )
    rolled = order_totals_rollup(orders, items)
    assert rolled.schema == orders.schema
    found = by_key(rolled, "order_id")
    assert tuple(found[1])[1:] == (Decimal(32), Decimal(25), Decimal(1), Decimal(9), Decimal(3))
    assert tuple(found[2])[1:] == tuple([Decimal(9)] * 5)
    assert found[3].total_amount is None
    assert set(found) == {1, 2, 3}
