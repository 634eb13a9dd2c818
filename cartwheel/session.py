"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Spark settings the plans count on. Adaptive execution sizes the shuffles,
# splits skewed join partitions and picks broadcast joins from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Spark 4.1 or later; earlier ones know no such setting and ignore it.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str, *, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the library's settings; master and memory come from spark-submit.

    ``shuffle_partitions`` is the number a shuffle starts with. Choose it for the
    largest shuffle, at about 200 MB each; adaptive execution merges what is too many.
    """
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files behind: those of an execution go when it ends.

    Otherwise they stay until the driver collects the plan as garbage, and the files of a job's many
    shuffles lie on the executors' disks side by side.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of
    this machine; a cluster session without it is refused, since its executors
    would not see such a folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="cartwheel-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
