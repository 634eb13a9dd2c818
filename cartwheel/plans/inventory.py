"""Stock against sales per product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.numeric import day, first_match
from cartwheel.plans.rfm import SETTLED_STATUSES

# Sales windows in days and the bounds of days-of-inventory classes.
SHORT_WINDOW, LONG_WINDOW = 90, 365
SLOW_MOVING, MODERATE = 180, 90


def inventory_analysis(
    products: DataFrame,
    inventory: DataFrame,
    order_items: DataFrame,
    orders: DataFrame,
    *,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Available stock, sales rate, days of stock and a status for every product.

    One pass over the order lines serves both sales windows: the orders are cut
    down to the long window before the join, the short window is a condition in
    the sum.
    """
    short_start = F.date_sub(day(as_of), SHORT_WINDOW)
    recent = orders.where(
        F.col("status").isin(*SETTLED_STATUSES)
        & (F.col("order_date") >= F.date_sub(day(as_of), LONG_WINDOW))
    ).select("order_id", "order_date")
    sales = (
        order_items.select("order_id", "product_id", "quantity")
        .join(recent, "order_id")
        .groupBy("product_id")
        .agg(
            F.sum(F.when(F.col("order_date") >= short_start, F.col("quantity"))).alias("sold_short"),
            F.sum("quantity").alias("sold_long"),
        )
    )
    return against_sales(products, inventory, sales)


def against_sales(products: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """The report from what was sold of each product in both windows, ``sold_short`` and ``sold_long``."""
    stock = inventory.groupBy("product_id").agg(
        F.sum("stock_on_hand").alias("on_hand"),
        F.sum("reserved_quantity").alias("reserved"),
        F.avg("reorder_level").alias("avg_reorder_level"),
    )
    zero = F.lit(0)
    joined = (
        products.select("product_id", "product_name", "sku", "cost_price", "status")
        .join(stock, "product_id", "left")
        .join(sales, "product_id", "left")
        .withColumns(
            {
                "total_stock": F.coalesce("on_hand", zero),
                "qty_sold_90d": F.coalesce("sold_short", zero),
                "qty_sold_365d": F.coalesce("sold_long", zero),
            }
        )
    )
    cost_of_sales = F.col("qty_sold_365d") * F.coalesce("cost_price", zero)
    stock_value = F.col("total_stock") * F.col("cost_price")
    measured = joined.withColumns(
        {
            "available_stock": F.col("total_stock") - F.coalesce("reserved", zero),
            "daily_sales_rate": F.round(F.col("qty_sold_90d") / SHORT_WINDOW, 2),
            "dsi": F.when(
                cost_of_sales > 0, F.round(stock_value / cost_of_sales * LONG_WINDOW, 1)
            ),
        }
    )
    available, rate = F.col("available_stock"), F.col("daily_sales_rate")
    status = first_match(
        [
            (available <= 0, "Out of Stock"),
            (available < F.col("avg_reorder_level"), "Low Stock"),
            (F.col("dsi") > SLOW_MOVING, "Slow Moving"),
            (F.col("dsi") > MODERATE, "Moderate"),
        ],
        "Healthy",
    )
    return measured.select(
        "product_id", "product_name", "sku", "status", "total_stock", "available_stock",
        "avg_reorder_level", "qty_sold_90d", "qty_sold_365d", "daily_sales_rate",
        F.when(rate > 0, F.round(available / rate, 0)).alias("days_of_stock"),
        "dsi",
        status.alias("inventory_status"),
    )
