"""Transactions summed per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_transactions(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Count, total and mean amount of each user's transactions.

    Transactions are summed per user before the join, so a user with very many
    of them is a single row there.
    """
    mean_type = transactions.select(F.avg("amount").alias("m")).schema["m"].dataType
    spent = transactions.groupBy("user_id").agg(
        F.count("transaction_id").alias("transactions"),
        F.count("amount").alias("amounts"),
        F.sum("amount").alias("total"),
    )
    per_user = (
        users.select("user_id", "region", "name")
        .join(spent, "user_id")
        .groupBy("region", "user_id", "name")
        .agg(
            F.sum("transactions").alias("transaction_count"),
            F.sum("total").alias("total_amount"),
            F.sum("amounts").alias("amounts"),
        )
    )
    mean = F.when(F.col("amounts") > 0, F.col("total_amount") / F.col("amounts"))
    return per_user.select(
        "region", "user_id", "name", "transaction_count", "total_amount",
        mean.cast(mean_type).alias("avg_amount"),
    )
