"""View, cart and purchase funnel per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.numeric import percent


def conversion_funnel(clickstream: DataFrame, categories: DataFrame) -> DataFrame:
    """Event counts, distinct users and conversion rates of every category.

    Events without a category form a group of their own. Events are counted per
    category and user first: a popular category is then spread over its users,
    and the distinct users of a category are plain counts of those rows.
    """

    def events(kind: str):
        return F.count_if(F.col("event_type") == kind)

    per_user = clickstream.groupBy("category_id", "user_id").agg(
        events("view").alias("views"),
        events("add_to_cart").alias("add_to_carts"),
        events("purchase").alias("purchases"),
    )
    known_user = F.col("user_id").isNotNull()
    funnel = per_user.groupBy("category_id").agg(
        F.sum("views").alias("views"),
        F.sum("add_to_carts").alias("add_to_carts"),
        F.sum("purchases").alias("purchases"),
        F.count_if(known_user & (F.col("views") > 0)).alias("unique_viewers"),
        F.count_if(known_user & (F.col("purchases") > 0)).alias("unique_purchasers"),
    )
    return rates(funnel, categories)


def rates(funnel: DataFrame, categories: DataFrame) -> DataFrame:
    """The funnel from each category's counts of events and users."""
    views, carts, purchases = F.col("views"), F.col("add_to_carts"), F.col("purchases")
    return funnel.join(categories.select("category_id", "category_name"), "category_id", "left").select(
        "category_id", "category_name", "views", "add_to_carts", "purchases",
        "unique_viewers", "unique_purchasers",
        percent(carts, views).alias("view_to_cart_rate"),
        percent(purchases, carts).alias("cart_to_purchase_rate"),
        percent(purchases, views).alias("overall_conversion_rate"),
    )
