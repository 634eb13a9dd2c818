"""The jobs that move data through the raw, trusted and curated layers.

Tables and outputs that do not depend on each other are submitted to Spark a few
at a time, so that small ones do not leave a cluster idle. Large ones run one by one,
so that no more than one large shuffle lies on the executors' disks, and each removes its
shuffle files when it ends.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwheel import storage
from cartwheel.model import PRIMARY_KEYS, STAMP, STAMP_DATE, TRACKED_TABLES, VERSION, table_schema
from cartwheel.operators.clean import clean
from cartwheel.operators.versions import current_snapshot, dedup, restamp
from cartwheel.plans import attribution, dims, facts, funnel, inventory, promotions, rfm
from cartwheel.session import scratch, shuffles_removed
from cartwheel.sinks import tables
from cartwheel.sinks.watermarks import START, Watermarks
from cartwheel.sources import files
from cartwheel.sources.jdbc import click_table_as_files
from cartwheel.streaming import clickstream

# A source gives the rows of a table changed after a watermark, or all rows where it is None;
# with an overlap it is also asked, by ``inclusive=True``, for the rows changed at the watermark.
Source = Callable[..., DataFrame]
Result = TypeVar("Result")

PEOPLE_TABLES = frozenset({"users"})
AT_A_TIME = 4
LARGE = 64 * 2**20  # bytes of files from which on a table has the cluster to itself


def utc_stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def join_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _each(
    spark: SparkSession, names: Iterable[str], job: Callable[[str], Result], at_a_time: int, alone: Sequence[str] = ()
) -> dict[str, Result]:
    """Run a job for every name, first those ``alone`` one by one, in their order, then the others some at a time.

    A failing one does not stop the others; its error is raised at the end. No shuffle files are left behind.
    """
    names, run = list(names), inheritable_thread_target(spark)(job)
    others = [name for name in names if name not in alone]
    running = {}
    with shuffles_removed(spark):
        for part, workers in ((alone, 1), (others, at_a_time)):
            with ThreadPoolExecutor(max_workers=workers) as pool:
                running |= {name: pool.submit(run, name) for name in part}
    errors = {name: error for name, future in running.items() if (error := future.exception())}
    if errors:
        first = next(iter(errors.values()))
        first.add_note(f"failed: {', '.join(errors)}")
        raise first
    return {name: running[name].result() for name in names}


def _large(sizes: Mapping[str, int]) -> list[str]:
    """The tables of more than ``LARGE`` bytes, the largest first."""
    return sorted((name for name, size in sizes.items() if size > LARGE), key=lambda name: -sizes[name])


def _sizes(spark: SparkSession, layer_path: str, table_names: Iterable[str]) -> dict[str, int]:
    return {table: storage.size(spark, join_path(layer_path, table)) for table in table_names}


@contextmanager
def _run_folder(spark: SparkSession, layer: str) -> Iterator[str]:
    """A scratch folder for the intermediate tables of one run, removed after it."""
    folder = scratch(spark, layer)
    try:
        yield folder
    finally:
        if storage.exists(spark, folder):
            storage.delete(spark, folder)


# Raw layer.


def earlier(watermark: str, by: dt.timedelta) -> str:
    """A watermark moved back in time."""
    return (dt.datetime.fromisoformat(watermark) - by).isoformat(sep=" ")


def stamped(df: DataFrame, stamp: str) -> DataFrame:
    return df.withColumn(STAMP, F.lit(stamp).cast("timestamp"))


def load_raw(
    spark: SparkSession,
    source: Source,
    raw_path: str,
    table_names: Iterable[str],
    watermarks: Watermarks,
    *,
    stamp: str | None = None,
    overlap: dt.timedelta | None = None,
    single_partition: bool = False,
    at_a_time: int = AT_A_TIME,
) -> list[str]:
    """Append the changed rows of tracked tables, rewrite the others; returns the tables written.

    The next run starts after the highest change time written here, which is
    observed during the write and costs no further pass.

    A row committed late, with a change time at or before that of rows already read, is only found with
    an ``overlap``: rows are then read from the watermark less the overlap on, that instant included. Choose it longer than
    the longest transaction. What is read twice does no harm, as the trusted layer keeps the
    latest row per key.
    """
    stamp = stamp or utc_stamp()
    known = watermarks.of_layer("raw")

    def changed(table: str) -> DataFrame:
        if table not in TRACKED_TABLES:
            return source(table, None)
        if overlap is None or table not in known:
            return source(table, known.get(table, START))
        return source(table, earlier(known[table], overlap), inclusive=True)

    def load(table: str) -> bool:
        tracked = table in TRACKED_TABLES
        rows = changed(table)
        if rows.isEmpty():
            return False
        out = stamped(rows, stamp).withColumn(STAMP_DATE, F.lit(stamp[:10]))
        path = join_path(raw_path, table)
        layout = {"partition_by": (STAMP_DATE,), "single_partition": single_partition}
        if tracked:
            seen = Observation(f"raw {table}")
            marked = out.observe(seen, F.max(VERSION).cast("string").alias("highest"))
            tables.append(marked, path, **layout)
            highest = seen.get["highest"]
            if highest is not None:
                watermarks.put("raw", table, max(highest, known.get(table, START)))
        else:
            tables.replace(out, path, **layout)
        return True

    done = _each(spark, table_names, load, at_a_time)
    return [table for table, written in done.items() if written]


# Trusted layer.


def refine(raw: DataFrame, table: str, stamp: str) -> DataFrame:
    """Clean a raw batch, keep the latest row per key and stamp it."""
    cleaned = clean(raw.drop(STAMP_DATE), people=table in PEOPLE_TABLES)
    return restamp(dedup(cleaned, PRIMARY_KEYS.get(table, ())), stamp)


def refine_since(raw: DataFrame, table: str, watermark: str, stamp: str) -> DataFrame:
    return refine(files.changed_since(raw, STAMP, watermark), table, stamp)


def load_trusted(
    spark: SparkSession,
    raw_path: str,
    trusted_path: str,
    table_names: Iterable[str],
    watermarks: Watermarks,
    *,
    stamp: str | None = None,
    single_partition: bool = False,
    at_a_time: int = AT_A_TIME,
) -> list[str]:
    """Refine what arrived in the raw layer since the last run; returns the tables written."""
    stamp = stamp or utc_stamp()
    known = watermarks.of_layer("trusted")

    def load(table: str) -> bool:
        raw = files.parquet_if_any(spark, join_path(raw_path, table))
        if raw is None:
            return False
        batch = files.changed_since(raw, STAMP, known.get(table, START))
        (highest,) = batch.agg(F.max(STAMP).cast("string")).first()
        if highest is None:
            return False
        tables.append(
            refine(batch, table, stamp),
            join_path(trusted_path, table),
            partition_by=(STAMP_DATE,),
            single_partition=single_partition,
        )
        watermarks.put("trusted", table, highest)
        return True

    table_names = list(table_names)
    done = _each(spark, table_names, load, at_a_time, _large(_sizes(spark, raw_path, table_names)))
    return [table for table, written in done.items() if written]


# Curated layer.


# What the outputs read of the widest tables; snapshots leave the rest behind.
CURATED_COLUMNS: dict[str, tuple[str, ...]] = {
    "clickstream": ("event_id", "user_id", "event_type", "category_id", "channel_id", "event_time"),
    "orders": (
        "order_id", "user_id", "order_date", "total_amount", "subtotal_amount", "tax_amount", "shipping_fee",
        "discount_amount", "status", "payment_method", "payment_status", "source_channel", "device_type",
    ),
    "order_items": (
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_amount", "tax_amount",
        "line_total",
    ),
}


def no_rows(spark: SparkSession, table: str) -> DataFrame:
    """The trusted form of a table without rows."""
    raw = spark.createDataFrame([], table_schema(table))
    if table == "clickstream":
        raw = click_table_as_files(raw)
    return refine(raw.withColumn(STAMP, F.current_timestamp()), table, START)


def current(
    spark: SparkSession,
    trusted_path: str,
    table_names: Iterable[str],
    folder: str,
    *,
    append_only: Iterable[str] = (),
    at_a_time: int = AT_A_TIME,
) -> dict[str, DataFrame]:
    """The latest state of trusted tables, of the widest only the curated columns.

    A table said to be ``append_only`` is read as it is. Of the others the latest
    rows are written below ``folder`` once, since most tables feed several outputs.
    A table that nothing has been written to yet is empty, with the columns of the data model.
    """
    append_only = frozenset(append_only)

    def latest(table: str) -> DataFrame:
        history = files.parquet_if_any(spark, join_path(trusted_path, table))
        if history is None:
            return no_rows(spark, table)
        if table in append_only:
            return history
        wanted = {*CURATED_COLUMNS.get(table, history.columns), *PRIMARY_KEYS[table], VERSION, STAMP}
        narrow = history.select(*(name for name in history.columns if name in wanted))
        snapshot = current_snapshot(narrow, PRIMARY_KEYS[table])
        path = f"{folder}/{table}"
        tables.write(snapshot, path, "errorifexists")
        return files.parquet(spark, path)

    return _each(spark, table_names, latest, at_a_time)


@dataclass(frozen=True)
class Output:
    """How a curated table is built from trusted ones; ``dated`` ones depend on the report date."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    dated: bool = False

    def __call__(self, trusted: Mapping[str, DataFrame], as_of: dt.date | str | None) -> DataFrame:
        options = {"as_of": as_of} if self.dated else {}
        return self.build(*(trusted[table] for table in self.inputs), **options)


GROUPS: dict[str, dict[str, Output]] = {
    "dims": {
        "dim_users": Output(dims.dim_users, ("users",)),
        "dim_products": Output(dims.dim_products, ("products", "categories")),
        "dim_promotions": Output(dims.dim_promotions, ("promotions",)),
        "dim_marketing_channels": Output(dims.dim_marketing_channels, ("marketing_channels",)),
    },
    "facts": {
        "fact_orders": Output(facts.fact_orders, ("orders", "order_items", "order_promotions")),
        "fact_order_items": Output(facts.fact_order_items, ("order_items", "orders")),
    },
    "q1": {
        "gold_q1_conversion_funnel": Output(funnel.conversion_funnel, ("clickstream", "categories")),
    },
    "q2": {
        "gold_q2_rfm_segmentation": Output(rfm.rfm_segmentation, ("orders", "users"), dated=True),
    },
    "q3": {
        "gold_q3_promo_comparison": Output(promotions.promo_comparison, ("orders", "order_promotions")),
        "gold_q3_promo_detail": Output(
            promotions.promo_detail, ("orders", "order_promotions", "promotions")
        ),
    },
    "q4": {
        "gold_q4_inventory_analysis": Output(
            inventory.inventory_analysis, ("products", "inventory", "order_items", "orders"), dated=True
        ),
    },
    "q5": {
        "gold_q5_attribution": Output(
            attribution.channel_attribution, ("clickstream", "marketing_channels")
        ),
    },
}


# Outputs of large tables are made one by one, in this order. Those that read the same tables follow each other, as the
# snapshot of a table is kept from the first to the last of them. The facts are as large as their sources, so the larger
# one comes when the snapshots it does not read are gone.
ONE_BY_ONE: tuple[str, ...] = (
    "gold_q1_conversion_funnel", "gold_q5_attribution", "gold_q4_inventory_analysis", "fact_orders",
    "gold_q3_promo_comparison", "gold_q3_promo_detail", "fact_order_items", "gold_q2_rfm_segmentation",
)


def load_curated(
    spark: SparkSession,
    trusted_path: str,
    curated_path: str,
    *,
    groups: Sequence[str] = tuple(GROUPS),
    as_of: dt.date | str | None = None,
    append_only: Iterable[str] = (),
    mode: str = "overwrite",
    single_partition: bool = False,
    preview_rows: int = 0,
    at_a_time: int = AT_A_TIME,
) -> list[str]:
    """Rebuild the outputs of the chosen groups; returns their names.

    The mode ``overwrite`` replaces an output only once its new content is complete;
    any other mode is Spark's own. Previews are read from what was written, so no
    output is computed twice. The snapshot of a large table is there from the first to the last output that reads it.
    """
    outputs = {name: output for group in groups for name, output in GROUPS[group].items()}
    needed = dict.fromkeys(table for output in outputs.values() for table in output.inputs)
    append_only = frozenset(append_only)
    large = _large(_sizes(spark, trusted_path, needed))
    alone = [name for name in dict.fromkeys((*ONE_BY_ONE, *outputs)) if name in outputs and {*large} & {*outputs[name].inputs}]
    with _run_folder(spark, "curated") as folder:

        def snapshots(wanted: Iterable[str]) -> dict[str, DataFrame]:
            return current(spark, trusted_path, wanted, folder, append_only=append_only, at_a_time=at_a_time)

        trusted = snapshots(table for table in needed if table not in large)

        def load(name: str) -> None:
            path, content = join_path(curated_path, name), outputs[name](trusted, as_of)
            if mode == "overwrite":
                tables.replace(content, path, single_partition=single_partition)
            else:
                tables.write(content, path, mode, single_partition=single_partition)

        def load_alone(name: str) -> None:
            for table in large:
                if table in outputs[name].inputs and table not in trusted:
                    trusted.update(snapshots([table]))
            try:
                load(name)
            finally:
                later = {table for other in alone[alone.index(name) + 1 :] for table in outputs[other].inputs}
                for table in trusted.keys() & {*large} - later - append_only:
                    del trusted[table]
                    storage.delete(spark, f"{folder}/{table}")

        _each(spark, outputs, lambda name: load_alone(name) if name in alone else load(name), at_a_time, alone)
    if preview_rows > 0:
        for name in outputs:
            tables.preview(files.parquet(spark, join_path(curated_path, name)), name, preview_rows)
    return list(outputs)


# All layers in order.


def run_pipeline(
    spark: SparkSession,
    source: Source,
    root: str,
    *,
    click_path: str | None = None,
    table_names: Sequence[str] = tuple(PRIMARY_KEYS),
    groups: Sequence[str] = tuple(GROUPS),
    as_of: dt.date | str | None = None,
    keep_clicks: bool = True,
) -> DataFrame:
    """Clicks, raw, trusted and curated layer below ``root``; returns the rows held per table.

    Without ``keep_clicks`` the folder of click files, to which nothing may be added meanwhile, is deleted once the raw
    layer has them all.
    """
    raw, trusted, curated = (join_path(root, layer) for layer in ("bronze", "silver", "gold"))
    watermarks = Watermarks(spark, join_path(root, "watermarks"))
    from_database = list(table_names)
    if click_path:
        clickstream.ingest_once(
            spark, click_path, join_path(raw, "clickstream"), join_path(root, "checkpoints", "clickstream")
        )
        if not keep_clicks:
            storage.delete(spark, click_path)
        from_database = [table for table in from_database if table != "clickstream"]
    load_raw(spark, source, raw, from_database, watermarks)
    load_trusted(spark, raw, trusted, table_names, watermarks)
    written = load_curated(spark, trusted, curated, groups=groups, as_of=as_of)
    held = [("bronze", raw, table) for table in table_names]
    held += [("silver", trusted, table) for table in table_names]
    held += [("gold", curated, table) for table in written]
    counts = []
    for layer, path, table in held:
        rows = files.parquet_if_any(spark, join_path(path, table))
        if rows is not None:
            counts.append(
                rows.agg(
                    F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.count("*").alias("row_count")
                )
            )
    return reduce(DataFrame.unionByName, counts)
