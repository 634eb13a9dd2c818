"""Customer segments by recency, frequency and money spent."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.numeric import at_least, at_most, day, first_match


# Settled order states, score bounds and segment bounds.
SETTLED_STATUSES = ("Paid", "Shipped")


@dataclass(frozen=True)
class RfmRules:
    recency_days: tuple[tuple[int, int], ...] = ((30, 5), (60, 4), (90, 3), (180, 2))
    frequency: tuple[tuple[int, int], ...] = ((10, 5), (5, 4), (3, 3), (2, 2))
    monetary: tuple[tuple[int, int], ...] = ((1000, 5), (500, 4), (200, 3), (100, 2))
    vip: int = 13
    loyal: int = 10
    potential: int = 7


def settled(orders: DataFrame) -> DataFrame:
    """The orders that count as spending."""
    return orders.where(F.col("status").isin(*SETTLED_STATUSES))


def rfm_segmentation(
    orders: DataFrame,
    users: DataFrame,
    *,
    as_of: dt.date | str | None = None,
    rules: RfmRules = RfmRules(),
) -> DataFrame:
    """Score every customer with a settled order and name their segment."""
    spending = settled(orders).groupBy("user_id").agg(
        F.count("order_id").alias("frequency"),
        F.sum("total_amount").alias("monetary"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return segments(spending, users, as_of=as_of, rules=rules)


def segments(
    spending: DataFrame,
    users: DataFrame,
    *,
    as_of: dt.date | str | None = None,
    rules: RfmRules = RfmRules(),
) -> DataFrame:
    """Scores and segments from the number, sum, first and last date of each customer's settled orders."""
    scored = spending.withColumn("recency_days", F.datediff(day(as_of), F.to_date("last_order_date"))).withColumns(
        {
            "r_score": at_most(F.col("recency_days"), rules.recency_days, 1),
            "f_score": at_least(F.col("frequency"), rules.frequency, 1),
            "m_score": at_least(F.col("monetary"), rules.monetary, 1),
        }
    ).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    # Segment names, the bounds 2 and 3 of lapsed customers, the output columns.
    total, lapsed = F.col("rfm_score"), F.col("r_score") <= 2
    segment = first_match(
        [
            (total >= rules.vip, "VIP"),
            (total >= rules.loyal, "Loyal"),
            (total >= rules.potential, "Potential"),
            (lapsed & (F.col("f_score") >= 3), "At Risk"),
            (lapsed, "Churn Risk"),
        ],
        "New/Casual",
    )
    profiles = users.select("user_id", "full_name", "email", "loyalty_segment")
    return scored.join(profiles, "user_id", "left").select(
        "user_id", "full_name", "email", "loyalty_segment", "recency_days", "frequency",
        F.round("monetary", 2).alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_score",
        segment.alias("customer_segment"),
        "first_order_date", "last_order_date",
    )
