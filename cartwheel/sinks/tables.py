"""Parquet sinks of the three layers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from cartwheel import storage

CODEC = "zstd"  # a fifth to a third smaller than Spark's default in these tables, and no slower


def write(
    df: DataFrame,
    path: str,
    mode: str,
    *,
    partition_by: Sequence[str] = (),
    single_partition: bool = False,
) -> None:
    """Write with the given mode; ``single_partition`` puts all rows in one file, for debugging."""
    if single_partition:
        df = df.repartition(1)
    writer = df.write.mode(mode).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append(df: DataFrame, path: str, **options) -> None:
    """Add rows to a table.

    Folders written by a stream list their files in a log, and readers ignore any
    other file there; a batch append would be lost, so it is refused.
    """
    if storage.exists(df.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream; append through the stream or use another folder")
    write(df, path, "append", **options)


def replace(df: DataFrame, path: str, **options) -> None:
    """Put new content in place of a table, keeping the old one until the new one is complete.

    The rows are written beside the table and moved in. An error while writing removes what
    was written, and one while moving restores the old content; both are raised. Between the two
    moves there is no table for a moment; readers that must not meet it read a version folder of their own.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    staged, retired = f"{path}.staged-{run}", f"{path}.retired-{run}"
    try:
        write(df, staged, "errorifexists", **options)
    except Exception:
        if storage.exists(spark, staged):
            storage.delete(spark, staged)
        raise
    had_content = storage.exists(spark, path)
    if had_content:
        storage.rename(spark, path, retired)
    try:
        storage.rename(spark, staged, path)
    except Exception:
        if had_content:
            storage.rename(spark, retired, path)
        storage.delete(spark, staged)
        raise
    if had_content:
        storage.delete(spark, retired)


def preview(df: DataFrame, name: str, rows: int = 20) -> None:
    """Print the first rows; nothing where ``rows`` is 0 or less."""
    if rows > 0:
        print(f"=== {name}: first {rows} rows ===")
        df.show(rows, truncate=False)
