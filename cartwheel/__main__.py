"""Command line of the jobs, for spark-submit: ``python -m cartwheel <job> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from cartwheel import storage
from cartwheel.model import PRIMARY_KEYS
from cartwheel.plans import layers
from cartwheel.plans.transactions import user_transactions
from cartwheel.plans.updates import update_curated
from cartwheel.session import session
from cartwheel.sinks import tables
from cartwheel.sinks.watermarks import Watermarks
from cartwheel.sources import files, jdbc
from cartwheel.streaming import clickstream


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def _yes(text: str) -> bool:
    return text.lower() == "true"


def _split(text: str) -> tuple[str, jdbc.Split | jdbc.Depths]:
    table, _, ranges = text.partition("=")
    column, *bounds, partitions = ranges.split(",")
    if not bounds:
        return table, jdbc.Depths(column, int(partitions))
    lower, upper = bounds
    return table, jdbc.Split(column, lower, upper, int(partitions))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cartwheel")
    top.add_argument("--shuffle_partitions", type=int, help="how many partitions a shuffle starts with")
    jobs = top.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze", help="read changed rows of database tables")
    bronze.add_argument("--tables", type=_names, default=list(PRIMARY_KEYS))
    bronze.add_argument("--jdbc_url", required=True)
    bronze.add_argument("--jdbc_user", required=True)
    secret = bronze.add_mutually_exclusive_group(required=True)
    secret.add_argument("--jdbc_password", help="shows in process lists; prefer one of the others")
    secret.add_argument("--jdbc_password_env", metavar="NAME", help="environment variable that holds the password")
    secret.add_argument("--jdbc_password_file", metavar="PATH", help="file that holds the password")
    bronze.add_argument("--bronze_out", required=True)
    bronze.add_argument("--watermarks", required=True)
    bronze.add_argument(
        "--overlap_seconds", type=int,
        help="read again what changed this long before the watermark, to find rows committed late",
    )
    bronze.add_argument(
        "--split", type=_split, action="append", default=[], metavar="TABLE=COLUMN[,LOWER,UPPER],PARTITIONS",
        help="read a large table through several connections; without bounds, parts of equal size are found by a sample",
    )

    clicks = jobs.add_parser("clickstream", help="ingest click-event files")
    clicks.add_argument("--input_path", required=True)
    clicks.add_argument("--bronze_out", required=True)
    clicks.add_argument("--checkpoint_path", required=True)
    clicks.add_argument("--mode", choices=("once", "continuous"), default="once")
    clicks.add_argument("--trigger_interval", default=clickstream.INTERVAL)
    clicks.add_argument("--files_per_trigger", type=int)
    clicks.add_argument("--unique_within", help="time in which an event that is sent again is left out, such as '7 days'")

    silver = jobs.add_parser("silver", help="clean and de-duplicate what is new in the raw layer")
    silver.add_argument("--tables", type=_names, default=list(PRIMARY_KEYS))
    silver.add_argument("--bronze_path", required=True)
    silver.add_argument("--silver_out", required=True)
    silver.add_argument("--watermarks", required=True)

    gold = jobs.add_parser("gold", help="rebuild dimensions, facts and marts")
    gold.add_argument("--silver_path", required=True)
    gold.add_argument("--gold_path", required=True)
    gold.add_argument("--as_of", help="report date, today if not given")
    gold.add_argument("--append_only", type=_names, default=[], help="tables that never hold a key twice")
    gold.add_argument("--mode", default="overwrite", help="how outputs are written; overwrite replaces them whole")
    gold.add_argument("--preview_rows", type=int, default=20)
    for group in layers.GROUPS:
        gold.add_argument(f"--build_{group}", type=_yes, default=True)

    marts = jobs.add_parser("update", help="bring funnel, segments and attribution up to date with what is new in the trusted layer")
    marts.add_argument("--silver_path", required=True)
    marts.add_argument("--state_path", required=True)
    marts.add_argument("--gold_path", required=True)
    marts.add_argument("--watermarks", required=True)
    marts.add_argument("--as_of", help="report date, today if not given")

    users = jobs.add_parser("transactions", help="sum transactions per user from two CSV files")
    users.add_argument("--users", required=True)
    users.add_argument("--transactions", required=True)
    users.add_argument("--output", required=True)
    users.add_argument("--partition_by", type=_names, default=["region"])
    users.add_argument("--preview_rows", type=int, default=10)

    for job in (bronze, silver, gold):
        job.add_argument("--single_partition", action="store_true", help="one output file, for debugging")
    return top


def _password(args: argparse.Namespace) -> str:
    if args.jdbc_password_env:
        return os.environ[args.jdbc_password_env]
    if args.jdbc_password_file:
        return Path(args.jdbc_password_file).read_text().strip()
    return args.jdbc_password


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "bronze":
        database = jdbc.Database(args.jdbc_url, args.jdbc_user, _password(args))
        splits = dict(args.split)
        layers.load_raw(
            spark,
            lambda table, watermark, inclusive=False: jdbc.read_table(
                spark, database, table, watermark, split=splits.get(table), inclusive=inclusive
            ),
            args.bronze_out,
            args.tables,
            Watermarks(spark, args.watermarks),
            overlap=None if args.overlap_seconds is None else dt.timedelta(seconds=args.overlap_seconds),
            single_partition=args.single_partition,
        )
    elif args.job == "clickstream":
        table_path = layers.join_path(args.bronze_out, "clickstream")
        continuous = args.mode == "continuous"
        if not continuous and storage.is_file(spark, args.input_path):
            clickstream.ingest_batch(spark, args.input_path, table_path)
        else:
            clickstream.start(
                spark,
                args.input_path,
                table_path,
                args.checkpoint_path,
                continuous=continuous,
                interval=args.trigger_interval,
                files_per_trigger=args.files_per_trigger,
                unique_within=args.unique_within,
            ).awaitTermination()
    elif args.job == "silver":
        layers.load_trusted(
            spark,
            args.bronze_path,
            args.silver_out,
            args.tables,
            Watermarks(spark, args.watermarks),
            single_partition=args.single_partition,
        )
    elif args.job == "gold":
        layers.load_curated(
            spark,
            args.silver_path,
            args.gold_path,
            groups=[group for group in layers.GROUPS if getattr(args, f"build_{group}")],
            as_of=args.as_of,
            append_only=args.append_only,
            mode=args.mode,
            single_partition=args.single_partition,
            preview_rows=args.preview_rows,
        )
    elif args.job == "update":
        written = update_curated(
            spark, args.silver_path, args.state_path, args.gold_path, Watermarks(spark, args.watermarks), as_of=args.as_of
        )
        print(f"written: {', '.join(written)}")
    else:
        summed = user_transactions(
            files.csv_with_header(spark, args.users), files.csv_with_header(spark, args.transactions)
        )
        tables.replace(summed, args.output, partition_by=args.partition_by)
        written = files.parquet(spark, args.output)
        print(f"rows: {written.count()}")
        tables.preview(written, "user transactions", args.preview_rows)


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = session(f"cartwheel {args.job}", shuffle_partitions=args.shuffle_partitions)
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
