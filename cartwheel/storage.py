"""Folder operations through Hadoop, so that any file system Spark writes to works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def is_file(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place) and files.getFileStatus(place).isFile()


def size(spark: SparkSession, path: str) -> int:
    """Bytes held by all files of a folder; 0 where there is none."""
    place, files = _at(spark, path)
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def rename(spark: SparkSession, source: str, target: str) -> None:
    place, files = _at(spark, source)
    if not files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    place, files = _at(spark, path)
    if not files.delete(place, True):
        raise OSError(f"could not delete {path}")
