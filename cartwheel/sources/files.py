"""CSV and Parquet sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import storage
from cartwheel.model import STAMP, STAMP_DATE, click_file_schema


def in_memory(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str] | str) -> DataFrame:
    """A small relation from literal rows."""
    return spark.createDataFrame(rows, names)


def click_files(spark: SparkSession, path: str) -> DataFrame:
    """Headerless click-event files: one file, or the ``*.csv`` files of a folder."""
    reader = spark.read.schema(click_file_schema()).option("header", False)
    if not storage.is_file(spark, path):
        reader = reader.option("pathGlobFilter", "*.csv")
    return reader.csv(path)


def click_file_stream(
    spark: SparkSession, path: str, *, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """The same files as a stream; each file is read once, when it appears."""
    reader = spark.readStream.schema(click_file_schema()).option("header", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def csv_with_header(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line; types are inferred in an extra pass unless a schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parquet_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written yet."""
    return spark.read.parquet(path) if storage.exists(spark, path) else None


def changed_since(df: DataFrame, column: str, watermark: str, *, inclusive: bool = False) -> DataFrame:
    """Rows whose ``column`` lies after the watermark; compared as text where it is text.

    Where the table is partitioned by arrival date, the date prunes folders before
    the stamp prunes row groups.
    """
    bound = F.lit(watermark)
    if not isinstance(df.schema[column].dataType, T.StringType):
        bound = bound.cast(df.schema[column].dataType)
    later = F.col(column) >= bound if inclusive else F.col(column) > bound
    if column == STAMP and STAMP_DATE in df.columns:
        later = later & (F.col(STAMP_DATE) >= F.lit(watermark[:10]).cast("date"))
    return df.where(later)
