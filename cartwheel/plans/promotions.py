"""How promotions relate to order value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _weighted_mean(amount: str, weight: str, as_type: T.DataType) -> Column:
    """The mean of ``amount`` with every row counted ``weight`` times."""
    counted = F.sum(F.when(F.col(amount).isNotNull(), F.col(weight)))
    total = F.sum(F.col(amount) * F.col(weight))
    return F.when(counted > 0, total / counted).cast(as_type)


def _types(df: DataFrame, function, column: str) -> T.DataType:
    return df.select(function(column).alias("v")).schema["v"].dataType


def promo_comparison(
    orders: DataFrame, order_promotions: DataFrame, *, per_order: bool = False
) -> DataFrame:
    """Orders with against orders without a promotion.

    An order counts once per promotion applied to it; with ``per_order`` it counts
    once. The promotions of an order are counted before the join, so an order is
    a single row with a weight there, however many promotions it has.
    """
    applied = order_promotions.groupBy("order_id").agg(
        F.count("promo_id").alias("named"),
        F.count_if(F.col("promo_id").isNull()).alias("unnamed"),
    )
    named = F.coalesce(F.col("named"), F.lit(0))
    unnamed = F.coalesce(F.col("unnamed"), F.lit(1))
    if per_order:
        named, unnamed = F.least(named, F.lit(1)), F.when(named > 0, 0).otherwise(1)
    sides = F.inline(
        F.array(
            F.struct(F.lit(True).alias("has_promotion"), named.cast("bigint").alias("weight")),
            F.struct(F.lit(False).alias("has_promotion"), unnamed.cast("bigint").alias("weight")),
        )
    )
    weighted = (
        orders.select("order_id", "total_amount", "discount_amount")
        .join(applied, "order_id", "left")
        .select("order_id", "total_amount", "discount_amount", sides)
        .where("weight > 0")
    )
    return weighted.groupBy("has_promotion").agg(
        F.coalesce(F.sum(F.when(F.col("order_id").isNotNull(), F.col("weight"))), F.lit(0)).alias("num_orders"),
        _weighted_sum(orders, "total_amount").alias("total_revenue"),
        _weighted_mean("total_amount", "weight", _types(orders, F.avg, "total_amount")).alias("avg_order_value"),
        _weighted_sum(orders, "discount_amount").alias("total_discount"),
        _weighted_mean("discount_amount", "weight", _types(orders, F.avg, "discount_amount")).alias("avg_discount"),
    )


def _weighted_sum(df: DataFrame, amount: str) -> Column:
    return F.sum(F.col(amount) * F.col("weight")).cast(_types(df, F.sum, amount))


def promo_detail(orders: DataFrame, order_promotions: DataFrame, promotions: DataFrame) -> DataFrame:
    """Use, revenue and discount of every promotion that was applied.

    Uses are summed per order and promotion before the join with the orders and
    per promotion before the join with the promotions, which hold an id once.
    """
    uses = (
        order_promotions.where(F.col("promo_id").isNotNull())
        .groupBy("order_id", "promo_id")
        .agg(F.count("*").alias("weight"), F.sum("applied_amount").alias("applied"))
    )
    per_promo = (
        orders.select("order_id", "total_amount")
        .join(uses, "order_id")
        .groupBy("promo_id")
        .agg(
            F.sum("weight").alias("times_used"),
            _weighted_sum(orders, "total_amount").alias("total_revenue"),
            _weighted_mean("total_amount", "weight", _types(orders, F.avg, "total_amount")).alias("avg_order_value"),
            F.sum("applied").cast(_types(order_promotions, F.sum, "applied_amount")).alias("total_discount_given"),
        )
    )
    details = promotions.select("promo_id", "promo_code", "discount_percent", "campaign_name")
    given = F.col("total_discount_given")
    return per_promo.join(details, "promo_id", "left").select(
        "promo_id", "promo_code", "discount_percent", "campaign_name",
        "times_used", "total_revenue", "avg_order_value", "total_discount_given",
        F.when(given > 0, F.round(F.col("total_revenue") / given, 2)).alias("revenue_per_discount"),
    )
