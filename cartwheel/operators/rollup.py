"""Order totals recomputed from their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_totals_rollup(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """``orders`` with subtotal, tax, discount and total taken from the order's lines.

    Orders without lines keep their values. The new total is
    subtotal + tax + shipping fee - discount, NULL where the shipping fee is.
    """
    lines = order_items.groupBy("order_id").agg(
        F.coalesce(F.sum(F.col("unit_price") * F.col("quantity")), F.lit(0)).alias("_subtotal"),
        F.coalesce(F.sum("tax_amount"), F.lit(0)).alias("_tax"),
        F.coalesce(F.sum("discount_amount"), F.lit(0)).alias("_discount"),
    )
    has_lines = F.col("_subtotal").isNotNull()
    totals = {
        "subtotal_amount": F.col("_subtotal"),
        "tax_amount": F.col("_tax"),
        "discount_amount": F.col("_discount"),
        "total_amount": F.col("_subtotal") + F.col("_tax") + F.col("shipping_fee") - F.col("_discount"),
    }

    def updated(name: str) -> Column:
        if name not in totals:
            return F.col(name)
        kept_type = orders.schema[name].dataType
        return F.when(has_lines, totals[name].cast(kept_type)).otherwise(F.col(name)).alias(name)

    return orders.join(lines, "order_id", "left").select([updated(name) for name in orders.columns])
