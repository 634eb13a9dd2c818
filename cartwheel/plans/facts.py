"""Fact tables at order and order-line grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The output columns of the facts are those below.


def fact_orders(orders: DataFrame, order_items: DataFrame, order_promotions: DataFrame) -> DataFrame:
    """One row per order with its line and promotion totals; 0 where it has none.

    Both detail tables are summed per order first, so the joins are one to one
    and share the partitioning on ``order_id``.
    """
    lines = order_items.groupBy("order_id").agg(
        F.sum("quantity").alias("total_quantity"),
        F.count("order_item_id").alias("num_line_items"),
    )
    promos = order_promotions.groupBy("order_id").agg(
        F.sum("applied_amount").alias("promo_discount_total"),
        F.count("promo_id").alias("num_promos_applied"),
    )

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return (
        orders.join(lines, "order_id", "left")
        .join(promos, "order_id", "left")
        .select(
            "order_id", "user_id", "order_date", F.to_date("order_date").alias("order_date_key"),
            "total_amount", "subtotal_amount", "tax_amount", "shipping_fee", "discount_amount",
            or_zero("promo_discount_total"), or_zero("num_promos_applied"),
            "status", "payment_method", "payment_status", "source_channel", "device_type",
            or_zero("total_quantity"), or_zero("num_line_items"),
        )
    )


def fact_order_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line with its order's user and date.

    A single order with very many lines lands in one join partition; adaptive
    execution splits such a partition, as nothing above the join needs it whole.
    """
    heads = orders.select("order_id", "user_id", "order_date")
    return order_items.join(heads, "order_id", "left").select(
        "order_item_id", "order_id", "user_id", "product_id", "order_date",
        F.to_date("order_date").alias("order_date_key"),
        "quantity", "unit_price", "discount_amount", "tax_amount", "line_total",
    )
