"""How far each layer has read each table.

The state is an append-only Parquet table, partitioned by layer and table, with one
row per run. A run appends its row after its data, so a run that dies in between is
repeated; the key de-duplication downstream makes the repetition harmless. Rows go
straight into their own partition folder, so that tables can advance side by side.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartwheel import storage

START = "1970-01-01 00:00:00"
STATE_DDL = "last_watermark STRING, recorded_at TIMESTAMP, layer STRING, table_name STRING"


class Watermarks:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._path = path

    def of_layer(self, layer: str) -> dict[str, str]:
        """The last recorded watermark of every table of a layer, as text."""
        if not storage.exists(self._spark, self._path):
            return {}
        latest = (
            self._spark.read.schema(STATE_DDL)
            .parquet(self._path)
            .where(F.col("layer") == layer)
            .groupBy("table_name")
            .agg(F.max_by("last_watermark", F.struct("recorded_at", "last_watermark")))
        )
        return {table: watermark for table, watermark in latest.collect()}

    def get(self, layer: str, table: str) -> str:
        """The last recorded watermark of a table; the epoch where there is none."""
        return self.of_layer(layer).get(table, START)

    def put(self, layer: str, table: str, watermark: str) -> None:
        row = self._spark.range(1, numPartitions=1).select(
            F.lit(watermark).alias("last_watermark"), F.current_timestamp().alias("recorded_at")
        )
        row.write.mode("append").parquet(f"{self._path}/layer={layer}/table_name={table}")
