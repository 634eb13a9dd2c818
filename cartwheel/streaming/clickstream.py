"""Click-event files into the raw layer, as a stream or as a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel import storage
from cartwheel.functions import text
from cartwheel.model import STAMP, STAMP_DATE
from cartwheel.operators.versions import new_rows
from cartwheel.sinks import tables
from cartwheel.sources import files

INTERVAL = "10 seconds"
FILES_PER_TRIGGER = 1


def shape(clicks: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Unread events with parsed time and flag and an arrival stamp; serves streams and batches."""
    return clicks.where(text.unset(F.col("is_read"))).withColumns(
        {
            "event_time": text.time_or_null(F.col("event_time")),
            "is_returning": text.truth(F.col("is_returning")),
            STAMP: F.current_timestamp() if stamp is None else stamp,
        }
    )


def unique(clicks: DataFrame, within: str) -> DataFrame:
    """The shaped events of a stream without those that came before, in this or an earlier file, ``within`` that time.

    Events are told apart by their id, those without one by their whole content. The time is that of arrival: no event is ever
    too late and dropped, and the state holds the ids of that time only. It is in the checkpoint and survives a restart.
    """
    content = [F.col(name) for name in clicks.columns if name != STAMP]
    whole = F.sha2(F.to_json(F.struct(*content)), 256)
    keyed = clicks.withColumn("_event", F.coalesce(F.col("event_id").cast("string"), whole))
    return keyed.withWatermark(STAMP, within).dropDuplicatesWithinWatermark(["_event"]).drop("_event")


def start(
    spark: SparkSession,
    input_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    continuous: bool = False,
    interval: str = INTERVAL,
    files_per_trigger: int | None = None,
    unique_within: str | None = None,
) -> StreamingQuery:
    """Start the ingest and return its query.

    With ``unique_within`` (such as ``7 days``) an event that is sent again in another file within that time lands once.

    By default it takes all ``*.csv`` files not yet taken and ends. With ``continuous`` it
    keeps polling at the interval, one file at a time unless told otherwise. In
    both cases the checkpoint remembers the files, and each is ingested once.

    The sink's file log grows by an entry per file. With many small files, keep the log short
    by its retention (``spark.sql.streaming.fileSink.log.*``) and let the trusted layer be the
    table that is read; the raw folder can then be started afresh with a new checkpoint.
    """
    if storage.exists(spark, table_path) and not storage.exists(spark, f"{table_path}/_spark_metadata"):
        raise ValueError(f"{table_path} holds files of a batch, which a stream's file log would hide")
    if continuous and files_per_trigger is None:
        files_per_trigger = FILES_PER_TRIGGER
    clicks = files.click_file_stream(
        spark, input_path, files_per_trigger=files_per_trigger, glob=None if continuous else "*.csv"
    )
    events = shape(clicks)
    writer = (
        (unique(events, unique_within) if unique_within else events)
        .withColumn(STAMP_DATE, F.to_date(STAMP))
        .writeStream.format("parquet")
        .partitionBy(STAMP_DATE)
        .outputMode("append")
        .option("path", table_path)
        .option("compression", tables.CODEC)
        .option("checkpointLocation", checkpoint_path)
    )
    trigger = {"processingTime": interval} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_once(
    spark: SparkSession, input_path: str, table_path: str, checkpoint_path: str, **options
) -> None:
    """Ingest all new files and wait for the end; raises what the stream raised."""
    start(spark, input_path, table_path, checkpoint_path, **options).awaitTermination()


def ingest_batch(spark: SparkSession, input_path: str, table_path: str) -> bool:
    """Append the events of growing files that the table lacks.

    For files that are appended to after they were first read, which a stream does
    not look at again. A row is new if the table holds none that equals it in all columns of
    the file; repeats of a row land once. Rows without an id land as well and are left to the
    trusted layer, which also settles ids that occur with different content. So the same
    rows land however the file grew between loads. Returns whether anything was new.
    """
    clicks = shape(files.click_files(spark, input_path))
    content = [name for name in clicks.columns if name != STAMP]
    if storage.exists(spark, table_path):
        clicks = new_rows(files.parquet(spark, table_path), clicks, content)
    elif clicks.isEmpty():  # a table without files could not be read again
        return False
    else:
        clicks = clicks.dropDuplicates(content)
    landed = Observation("clicks")
    marked = clicks.withColumn(STAMP_DATE, F.to_date(STAMP)).observe(landed, F.count(F.lit(1)).alias("rows"))
    tables.append(marked, table_path, partition_by=(STAMP_DATE,))
    return landed.get["rows"] > 0
