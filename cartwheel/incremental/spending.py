"""What customers spent, kept up to date from changed orders instead of being summed again.

A changed order counts as its old version taken back and its new one added. Numbers and sums of a customer take both. First and last
dates take what is added; only where a date that was first or last is taken back are they looked up again, among the orders of
those customers alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.incremental.buckets import BUCKET, PartitionedState, bucket_of, touched, written_once
from cartwheel.plans.rfm import settled

CUSTOMER = "user_id"
BATCH = "batch"  # the last one folded into a row's bucket
MONEY = "decimal(38,2)"
COLUMNS = (CUSTOMER, "orders", "amounts", "spent", "first_order_date", "last_order_date")


class Spending:
    """Per customer: number and sum of settled orders, first and last date; in buckets by the customer's hash."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = 64) -> None:
        self.spark, self.buckets = spark, buckets
        self.state = PartitionedState(spark, path, [BUCKET])

    def apply(self, changes: DataFrame, orders: DataFrame, batch: str | None = None) -> int:
        """Fold the changes that a ``Snapshot`` of orders reports; ``orders`` is that snapshot after them.

        Given the name of the batch, buckets that hold it already are left alone, so that an update which died may be repeated.
        Returns the number of customers whose first or last date had to be looked up.
        """
        batch = batch or uuid.uuid4().hex
        versions = changes.select(
            F.inline(F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("it")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("it"))))
        ).where("it IS NOT NULL").select("sign", "it.*")
        adds, takes, amount = F.col("sign") > 0, F.col("sign") < 0, F.col("total_amount").cast(MONEY)
        folded = (
            settled(versions)
            .groupBy(CUSTOMER)
            .agg(
                F.sum("sign").alias("orders"),
                F.coalesce(F.sum(F.when(amount.isNotNull(), F.col("sign"))), F.lit(0)).alias("amounts"),
                F.coalesce(F.sum(F.when(adds, amount).otherwise(-amount)), F.lit(0)).cast(MONEY).alias("spent"),
                F.min(F.when(adds, F.col("order_date"))).alias("first_order_date"),
                F.max(F.when(adds, F.col("order_date"))).alias("last_order_date"),
                F.min(F.when(takes, F.col("order_date"))).alias("first_taken"),
                F.max(F.when(takes, F.col("order_date"))).alias("last_taken"),
            )
            .withColumn(BUCKET, bucket_of([CUSTOMER], self.buckets))
        )
        deltas = written_once(folded, "spending-deltas")
        numbers = [number for (number,) in touched(deltas, BUCKET)]
        if not numbers:
            return 0
        held = self.state.read()
        if held is None:
            held = deltas.select(*COLUMNS, BUCKET, F.lit(batch).alias(BATCH)).where("false")
        done = {number for (number,) in touched(held.where(F.col(BUCKET).isin(numbers) & (F.col(BATCH) == batch)), BUCKET)}
        numbers = [number for number in numbers if number not in done]
        if not numbers:
            return 0
        deltas = deltas.where(F.col(BUCKET).isin(numbers))
        none = F.lit(None).cast(deltas.schema["first_taken"].dataType)
        old = held.where(F.col(BUCKET).isin(numbers)).select(*COLUMNS, BUCKET, none.alias("first_taken"), none.alias("last_taken"))
        merged = (
            old.unionByName(deltas)
            .groupBy(BUCKET, CUSTOMER)
            .agg(
                F.sum("orders").alias("orders"),
                F.sum("amounts").alias("amounts"),
                F.sum("spent").cast(MONEY).alias("spent"),
                F.min("first_order_date").alias("first_order_date"),
                F.max("last_order_date").alias("last_order_date"),
                F.max((F.col("first_taken").isNotNull()).cast("int")).alias("taken"),
                F.min("first_taken").alias("first_taken"),
                F.max("last_taken").alias("last_taken"),
            )
        )
        lost = (F.col("taken") > 0) & (
            (F.col("first_taken") <= F.col("first_order_date")) | (F.col("last_taken") >= F.col("last_order_date"))
        )
        merged = written_once(merged.withColumn("lost", F.coalesce(lost, F.lit(False)) & (F.col("orders") > 0)), "spending")
        sought = merged.where("lost").select(F.col(CUSTOMER).alias("_customer"))
        dates = (
            settled(orders).select(CUSTOMER, "order_date")
            .join(sought, F.col(CUSTOMER).eqNullSafe(F.col("_customer")), "left_semi")
            .groupBy(F.col(CUSTOMER).alias("_customer"))
            .agg(F.min("order_date").alias("_first"), F.max("order_date").alias("_last"))
        )
        found = written_once(dates, "order-dates")
        some, again = F.col("orders") > 0, F.col("lost")
        dated = merged.join(found, F.col(CUSTOMER).eqNullSafe(F.col("_customer")), "left").withColumns(
            {
                "first_order_date": F.when(some, F.when(again, F.col("_first")).otherwise(F.col("first_order_date"))),
                "last_order_date": F.when(some, F.when(again, F.col("_last")).otherwise(F.col("last_order_date"))),
            }
        )
        self.state.replace(dated.select(*COLUMNS, F.lit(batch).alias(BATCH), BUCKET))
        return sought.count()

    def read(self) -> DataFrame | None:
        """Customers with settled orders, as ``segments`` takes them; None before the first change."""
        rows = self.state.read()
        if rows is None:
            return None
        return rows.where("orders > 0").select(
            CUSTOMER,
            F.col("orders").alias("frequency"),
            F.when(F.col("amounts") > 0, F.col("spent")).alias("monetary"),
            "first_order_date",
            "last_order_date",
        )
