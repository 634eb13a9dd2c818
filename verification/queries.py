"""Every query of the library on the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import storage
from cartwheel.incremental.attribution import Attribution
from cartwheel.incremental.funnel import FunnelDays
from cartwheel.incremental.sales import MONTH, TrailingSales, dated_lines
from cartwheel.incremental.snapshots import Snapshot
from cartwheel.incremental.spending import Spending
from cartwheel.model import PRIMARY_KEYS, STAMP, STAMP_DATE, VERSION
from cartwheel.operators.clean import clean
from cartwheel.operators.key_bitmaps import fk_violations_by_bitmap, key_violations_by_bitmap
from cartwheel.operators.quality import email_phone_quality, fk_violations, key_violations
from cartwheel.operators.rollup import order_totals_rollup
from cartwheel.operators.versions import (
    current_snapshot,
    dedup,
    dedup_rare,
    insert_if_absent,
    restamp,
    upsert_latest,
)
from cartwheel.plans import dims, facts
from cartwheel.plans.attribution import channel_attribution
from cartwheel.plans.funnel import conversion_funnel
from cartwheel.plans.inventory import against_sales, inventory_analysis
from cartwheel.plans.layers import GROUPS, load_raw, refine_since, run_pipeline, stamped
from cartwheel.plans.promotions import promo_comparison, promo_detail
from cartwheel.plans.rfm import RfmRules, rfm_segmentation, segments
from cartwheel.plans.transactions import user_transactions
from cartwheel.session import scratch
from cartwheel.sinks.watermarks import Watermarks
from cartwheel.sources.files import changed_since, csv_with_header, parquet
from cartwheel.streaming import clickstream, touches
from verification import inputs
from verification.adapters import run, view

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01"
RAISED_RULES = RfmRules(
    recency_days=((60, 5), (180, 4), (365, 3), (730, 2)),
    frequency=((11, 5), (9, 4), (7, 3), (5, 2)),
    monetary=((3_000_000, 5), (2_200_000, 4), (1_500_000, 3), (800_000, 2)),
)
FIRST_STAMP, SECOND_STAMP, THIRD_STAMP = (
    "2001-08-02 00:00:00.000001",
    "2001-08-03 00:00:00.000002",
    "2001-08-04 00:00:00.000003",
)
BUCKETS = 4  # of states of the test tables, which are small
RAW_WATERMARK = "2000-01-01 00:00:00"
LATE_FROM, LATE_DAYS = "2001-05-01 00:00:00", 180
LINE_KEYS = ("l_orderkey", "l_linenumber")


def plain(df: DataFrame) -> DataFrame:
    """Numbers as long or double and times without zone, as the SQL checker returns them."""

    def column(field: T.StructField):
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(kind, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select([column(field) for field in df.schema.fields])


@contextmanager
def scratch_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder for the tables of one query, removed when the query is built."""
    folder = scratch(spark, purpose)
    try:
        yield folder
    finally:
        if storage.exists(spark, folder):
            storage.delete(spark, folder)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a folder that stays, for a result whose inputs are removed."""
    path = scratch(df.sparkSession, f"result-{purpose}")
    df.write.parquet(path)
    return parquet(df.sparkSession, path)


def on(build: Callable[..., DataFrame], *names: str, **options) -> Query:
    """A query that builds its result from commerce tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(*(view(spark, sf_dir, f"c_{name}") for name in names), **options))

    return query


def _user_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = view(spark, sf_dir, "c_users").select(
        "user_id", F.col("country").alias("region"), F.col("full_name").alias("name")
    )
    transactions = view(spark, sf_dir, "c_orders").select(
        F.col("order_id").alias("transaction_id"), "user_id", F.col("total_amount").alias("amount")
    )
    return plain(user_transactions(users, transactions))


def _bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = view(spark, sf_dir, "c_orders")
    return plain(stamped(changed_since(orders, VERSION, RAW_WATERMARK), FIRST_STAMP))


def _bronze_incremental_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded in two runs, of which some are committed only after later ones were read."""
    orders = view(spark, sf_dir, "c_orders")
    late = (F.col("order_id") % 7 == 0) & (F.col("updated_at") > F.lit(LATE_FROM).cast("timestamp_ntz"))
    with scratch_folder(spark, "overlap") as folder:
        watermarks = Watermarks(spark, f"{folder}/watermarks")
        for committed, stamp in ((orders.where(~late), FIRST_STAMP), (orders, SECOND_STAMP)):

            def source(table: str, watermark: str, inclusive: bool = False, rows: DataFrame = committed) -> DataFrame:
                return changed_since(rows, VERSION, watermark, inclusive=inclusive)

            load_raw(
                spark, source, f"{folder}/raw", ["orders"], watermarks, stamp=stamp, overlap=dt.timedelta(days=LATE_DAYS)
            )
        latest = dedup(parquet(spark, f"{folder}/raw/orders"), ("order_id",))
        return plain(kept(latest.select(orders.columns), "orders"))


def _raw_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a change time, loaded whole each time."""
    rows = view(spark, sf_dir, "c_warehouses")
    with scratch_folder(spark, "refresh") as folder:
        watermarks = Watermarks(spark, f"{folder}/watermarks")
        for part in (rows.where("warehouse_id % 2 = 0"), rows):
            load_raw(spark, lambda table, watermark, part=part: part, f"{folder}/raw", ["depots"], watermarks)
        return plain(kept(parquet(spark, f"{folder}/raw/depots").drop(STAMP, STAMP_DATE), "depots"))


def _clickstream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch_folder(spark, "clicks") as folder:
        run(spark, sf_dir, inputs.CLICK_ROWS).write.csv(f"{folder}/landing")
        clickstream.ingest_once(spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/checkpoint")
        return plain(kept(parquet(spark, f"{folder}/raw").drop(STAMP, STAMP_DATE), "clicks"))


def _clickstream_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read twice as a batch, the second time with more rows, some of which were there before."""
    rows = run(spark, sf_dir, inputs.CLICK_ROWS)
    with scratch_folder(spark, "clicks") as folder:
        for part in ("event_id % 2 = 0", "event_id % 2 = 1 OR event_id % 10 = 0"):
            rows.where(part).write.mode("append").csv(f"{folder}/landing")
            clickstream.ingest_batch(spark, f"{folder}/landing", f"{folder}/raw")
        return plain(kept(parquet(spark, f"{folder}/raw").drop(STAMP, STAMP_DATE), "clicks"))


def _clickstream_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that each trigger of a processing-time stream takes, at one file a trigger."""
    rows = run(spark, sf_dir, inputs.CLICK_ROWS)
    with scratch_folder(spark, "clicks") as folder:
        for part in range(3):
            rows.where(f"event_id % 3 = {part}").coalesce(1).write.mode("append").csv(f"{folder}/landing")
        query = clickstream.start(
            spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/checkpoint", continuous=True, interval="0 seconds"
        )
        try:
            query.processAllAvailable()
            taken = [(progress["numInputRows"],) for progress in query.recentProgress if progress["numInputRows"]]
        finally:
            query.stop()
            query.awaitTermination()
    return spark.createDataFrame(taken, "batch_rows bigint")


def _transactions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per user from files with a header, whose types are inferred, with the number of all users."""
    orders = view(spark, sf_dir, "c_orders").selectExpr("order_id AS transaction_id", "user_id", "total_amount AS amount")
    users = view(spark, sf_dir, "c_users").selectExpr("user_id", "country AS region", "full_name AS name")
    with scratch_folder(spark, "csv") as folder:
        for name, rows in (("orders", orders), ("users", users)):
            rows.write.option("header", True).csv(f"{folder}/{name}")
        read = [csv_with_header(spark, f"{folder}/{name}") for name in ("users", "orders")]
        summed = kept(user_transactions(*read), "sums")
    total = F.round("total_amount", 2)  # inferred amounts are doubles
    cents = {"total_amount": total, "avg_amount": F.round(total / F.col("transaction_count"), 2)}
    return plain(summed.withColumns(cents | {"row_count": F.lit(summed.count())}))


def _silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(clean(run(spark, sf_dir, inputs.DIRTY_USERS), people=True))


def _silver_dedup(operator: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = run(spark, sf_dir, inputs.LINES)
        return plain(restamp(operator(lines, LINE_KEYS, version="l_shipdate", stamp=None), SECOND_STAMP))

    return query


def _silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = F.col("order_id") % 3 == 0
    raw = view(spark, sf_dir, "c_orders").withColumn(
        STAMP, F.when(late, SECOND_STAMP).otherwise(FIRST_STAMP).cast("timestamp")
    )
    return plain(refine_since(raw, "orders", FIRST_STAMP, THIRD_STAMP))


def _current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run(spark, sf_dir, inputs.LINES)
    early = F.coalesce(F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz"), F.lit(False))
    batches = [
        restamp(dedup(lines.where(part), LINE_KEYS, version="l_shipdate", stamp=None), stamp)
        for part, stamp in ((early, FIRST_STAMP), (~early, SECOND_STAMP))
    ]
    history = batches[0].unionByName(batches[1])
    return plain(current_snapshot(history, LINE_KEYS, version="l_shipdate"))


def _order_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    loads = run(spark, sf_dir, inputs.ORDER_LOADS)
    return [loads.where(F.col("load") == number).drop("load") for number in (1, 2, 3)]


def _snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of orders after three loads, each merged into the buckets it touches."""
    with scratch_folder(spark, "snapshot") as folder:
        snapshot = Snapshot(spark, f"{folder}/orders", ("order_id",), buckets=BUCKETS)
        for load in _order_loads(spark, sf_dir):
            snapshot.apply(load)
        return plain(kept(snapshot.read(), "snapshot"))


def _q2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments from sums that follow the changes of three loads of orders."""
    with scratch_folder(spark, "spending") as folder:
        snapshot = Snapshot(spark, f"{folder}/orders", ("order_id",), buckets=BUCKETS)
        spending = Spending(spark, f"{folder}/spending", buckets=BUCKETS)
        for load in _order_loads(spark, sf_dir):
            spending.apply(snapshot.apply(load), snapshot.read())
        return plain(segments(kept(spending.read(), "spending"), view(spark, sf_dir, "c_users"), as_of=AS_OF))


def _q1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel from three arrival days, each counted when it arrived."""
    clicks, categories = view(spark, sf_dir, "c_clickstream"), view(spark, sf_dir, "c_categories")
    with scratch_folder(spark, "funnel") as folder:
        funnel = FunnelDays(spark, f"{folder}/funnel")
        for number, stamp in enumerate((FIRST_STAMP, SECOND_STAMP, THIRD_STAMP)):
            arrived = clicks.where(F.col("event_id") % 3 == number).withColumn(STAMP_DATE, F.lit(stamp[:10]).cast("date"))
            arrived.write.mode("append").partitionBy(STAMP_DATE).parquet(f"{folder}/clicks")
            funnel.refresh(parquet(spark, f"{folder}/clicks"), STAMP_DATE)
        return plain(kept(funnel.funnel(categories), "funnel"))


def _q5_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution after three batches of events, each with events of all days."""
    clicks, channels = view(spark, sf_dir, "c_clickstream"), view(spark, sf_dir, "c_marketing_channels")
    with scratch_folder(spark, "attribution") as folder:
        attribution = Attribution(spark, folder, buckets=BUCKETS // 2)
        late = F.col("event_id") % 9 == 0
        for number, part in enumerate((~late & (F.col("event_id") % 2 == 0), ~late & (F.col("event_id") % 2 == 1), late)):
            attribution.add(clicks.where(part), str(number))
        return plain(kept(attribution.credits_of(channels), "credits"))


def _q4_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock against sales whose windows were moved twice, with months of order lines that came later in between."""
    lines = dated_lines(view(spark, sf_dir, "c_order_items"), view(spark, sf_dir, "c_orders"))
    with scratch_folder(spark, "sales") as folder:
        lines.repartition(MONTH).write.partitionBy(MONTH).parquet(f"{folder}/lines")
        stored = spark.read.schema(lines.schema).parquet(f"{folder}/lines")
        months = sorted(month for (month,) in stored.select(MONTH).distinct().collect())
        sales = TrailingSales(spark, f"{folder}/sales")
        sales.refresh(stored, months[::2])
        sales.advance("2001-02-14")
        sales.refresh(stored, months[1::2])
        sales.advance(AS_OF)
        sold = kept(sales.read(), "sold")
    return plain(against_sales(view(spark, sf_dir, "c_products"), view(spark, sf_dir, "c_inventory"), sold))


def _clickstream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that repeat events of earlier ones, taken by a stream that is started twice."""
    rows = run(spark, sf_dir, inputs.CLICK_ROWS)
    with scratch_folder(spark, "clicks") as folder:
        for parts in (("event_id % 3 = 0", "event_id % 3 = 1 OR event_id % 6 = 0"), ("event_id % 3 = 2 OR event_id % 5 = 0",)):
            for part in parts:
                rows.where(part).coalesce(1).write.mode("append").csv(f"{folder}/landing")
            clickstream.ingest_once(
                spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/checkpoint", files_per_trigger=1, unique_within="7 days"
            )
        return plain(kept(parquet(spark, f"{folder}/raw").drop(STAMP, STAMP_DATE), "clicks"))


def _clickstream_touch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases joined with their touches as three files come in, one stretch of time each."""
    rows = run(spark, sf_dir, inputs.CLICK_ROWS).withColumn("_at", F.try_to_timestamp("event_time"))
    first, last = rows.agg(F.unix_seconds(F.min("_at")), F.unix_seconds(F.max("_at"))).first()
    third = F.least(F.floor((F.unix_seconds("_at") - first) * 3 / (last - first + 1)), F.lit(2))
    with scratch_folder(spark, "touches") as folder:
        for part in range(3):
            now = F.coalesce(third, F.lit(0)) == part
            rows.where(now).drop("_at").coalesce(1).write.mode("append").csv(f"{folder}/landing")
        touches.start(
            spark, f"{folder}/landing", f"{folder}/pairs", f"{folder}/checkpoint", lookback_days=3, files_per_trigger=1
        ).awaitTermination()
        return plain(kept(parquet(spark, f"{folder}/pairs"), "pairs"))


def _merge(operator: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = run(spark, sf_dir, inputs.BASE_ORDERS)
        incoming = run(spark, sf_dir, inputs.INCOMING_ORDERS)
        return plain(operator(base, incoming, ("order_id",)))

    return query


def _report(operator: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(operator({table: view(spark, sf_dir, f"c_{table}") for table in PRIMARY_KEYS}))

    return query


def _fk_violations_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"orders": inputs.TEXT_KEY_ORDERS, "users": inputs.TEXT_KEY_USERS}
    return plain(fk_violations({name: run(spark, sf_dir, text) for name, text in tables.items()}))


def _silver_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(dedup(run(spark, sf_dir, inputs.REPEATED_LINES), ()))


def _email_phone_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(email_phone_quality(run(spark, sf_dir, inputs.DIRTY_USERS)))


def column_totals(df: DataFrame, table: str) -> DataFrame:
    """For each column of a curated table: its filled values, the sum of numbers, and a sum over the digests of other values."""
    texts = df.select([F.col(name).cast("string").alias(name) for name in df.columns])
    number = F.col("value").try_cast("double")
    digest = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    return (
        texts.unpivot([], texts.columns, "column_name", "value")
        .groupBy("column_name")
        .agg(
            F.count("value").alias("filled"),
            # in whole ten-thousandths: a sum of doubles depends on their order, and one of longs overflows
            (F.coalesce(F.sum(F.round(number * 10_000).cast("bigint").cast("decimal(20,0)")), F.lit(0)).cast("double") / 10_000).alias("total"),
            F.coalesce(F.sum(F.when(number.isNull(), digest)), F.lit(0)).alias("letters"),
        )
        .select(F.lit("gold").alias("layer"), F.lit(table).alias("table_name"), "column_name", "filled", "total", "letters")
    )


def _pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all layers, and the content of the curated tables as totals of their columns."""

    def source(table: str, watermark: str | None) -> DataFrame:
        rows = view(spark, sf_dir, f"c_{table}")
        return rows if watermark is None else changed_since(rows, VERSION, watermark)

    with scratch_folder(spark, "pipeline") as root:
        run(spark, sf_dir, inputs.CLICK_ROWS).write.csv(f"{root}/landing")
        counts = run_pipeline(spark, source, root, click_path=f"{root}/landing", as_of=AS_OF, keep_clicks=False)
        rows = counts.select("layer", "table_name", F.lit("*").alias("column_name"), F.col("row_count").alias("filled"))
        totals = [column_totals(parquet(spark, f"{root}/gold/{name}"), name) for group in GROUPS.values() for name in group]
        whole = reduce(
            DataFrame.unionByName, totals, rows.withColumns({"total": F.lit(0.0), "letters": F.lit(0).cast("bigint")})
        )
        return plain(kept(whole, "report"))


QUERIES: dict[str, Query] = {
    "user_transactions": _user_transactions,
    "transactions_csv": _transactions_csv,
    "bronze_incremental": _bronze_incremental,
    "bronze_incremental_overlap": _bronze_incremental_overlap,
    "raw_refresh": _raw_refresh,
    "clickstream_ingest": _clickstream_ingest,
    "clickstream_batch": _clickstream_batch,
    "clickstream_continuous": _clickstream_continuous,
    "silver_clean": _silver_clean,
    "silver_dedup": _silver_dedup(dedup),
    "silver_dedup_rare": _silver_dedup(dedup_rare),
    "silver_distinct_rows": _silver_distinct_rows,
    "silver_incremental": _silver_incremental,
    "current_snapshot": _current_snapshot,
    "snapshot_incremental": _snapshot_incremental,
    "q1_funnel_incremental": _q1_incremental,
    "q2_rfm_incremental": _q2_incremental,
    "q4_inventory_incremental": _q4_incremental,
    "q5_attribution_incremental": _q5_incremental,
    "clickstream_unique": _clickstream_unique,
    "clickstream_touch_pairs": _clickstream_touch_pairs,
    "dim_users": on(dims.dim_users, "users"),
    "dim_products": on(dims.dim_products, "products", "categories"),
    "dim_promotions": on(dims.dim_promotions, "promotions"),
    "dim_marketing_channels": on(dims.dim_marketing_channels, "marketing_channels"),
    "fact_orders": on(facts.fact_orders, "orders", "order_items", "order_promotions"),
    "fact_order_items": on(facts.fact_order_items, "order_items", "orders"),
    "q1_conversion_funnel": on(conversion_funnel, "clickstream", "categories"),
    "q2_rfm_segmentation": on(rfm_segmentation, "orders", "users", as_of=AS_OF),
    "q2_rfm_segmentation_raised": on(rfm_segmentation, "orders", "users", as_of=AS_OF, rules=RAISED_RULES),
    "q3_promo_comparison": on(promo_comparison, "orders", "order_promotions"),
    "q3_promo_comparison_per_order": on(promo_comparison, "orders", "order_promotions", per_order=True),
    "q3_promo_detail": on(promo_detail, "orders", "order_promotions", "promotions"),
    "q4_inventory_analysis": on(
        inventory_analysis, "products", "inventory", "order_items", "orders", as_of=AS_OF
    ),
    "q5_attribution": on(channel_attribution, "clickstream", "marketing_channels"),
    "q5_attribution_week": on(channel_attribution, "clickstream", "marketing_channels", lookback_days=7),
    "order_totals_rollup": on(order_totals_rollup, "orders", "order_items"),
    "upsert_latest": _merge(upsert_latest),
    "insert_if_absent": _merge(insert_if_absent),
    "fk_violations": _report(fk_violations),
    "fk_violations_text_keys": _fk_violations_text_keys,
    "key_violations": _report(key_violations),
    "fk_violations_by_bitmap": _report(fk_violations_by_bitmap),
    "key_violations_by_bitmap": _report(key_violations_by_bitmap),
    "email_phone_quality": _email_phone_quality,
    "pipeline_run": _pipeline_run,
}
