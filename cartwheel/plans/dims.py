"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The output columns of the dimensions are those below.


def dim_users(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", "full_name", "email", "phone", "city", "state", "country", "gender",
        "date_of_birth", "loyalty_segment", "registration_source", "is_active",
        F.col("created_at").alias("registered_at"),
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select("category_id", "category_name")
    return products.join(names, "category_id", "left").select(
        "product_id", "product_name", "sku", "category_id", "category_name", "brand",
        "base_price", "cost_price", "status", "created_at",
    )


def dim_promotions(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        "promo_id", "promo_code", "discount_percent", "discount_type", "start_date", "end_date",
        "min_order_value", "max_discount_amount", "campaign_name",
    )


def dim_marketing_channels(channels: DataFrame) -> DataFrame:
    return channels.select(
        "channel_id", "channel_name", "channel_type", "platform", "utm_source", "utm_medium"
    )
