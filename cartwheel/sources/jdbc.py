"""Relational source tables over JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.model import CLICK_TABLE_RENAMES, TRACKED_TABLES, VERSION

# Driver class and rows per fetch.
DRIVER = "org.postgresql.Driver"
FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Split:
    """How to read a table in parallel: ranges of a numeric, date or time column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


@dataclass(frozen=True)
class Depths:
    """How to read a table in parallel without knowing its bounds: parts of about equal size, found from a sample of a column."""

    column: str
    partitions: int
    percent: float = 1.0  # of the table's pages that the sample reads

    def sample(self, table: str) -> str:
        return f"(SELECT {self.column} FROM {table} TABLESAMPLE SYSTEM ({self.percent})) AS sampled"

    def predicates(self, sample: DataFrame) -> list[str]:
        """Conditions of which every row of the table meets exactly one, whatever the sample missed."""
        return parts(self.column, boundaries(sample, self.column, self.partitions))


def boundaries(sample: DataFrame, column: str, partitions: int) -> list:
    """The values at which a column is cut into parts of about equal size; fewer where values repeat so often that parts coincide.

    Only counts per value leave the tasks, and only quantiles reach the driver.
    """
    kind = sample.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} is neither a number nor a time")
    shares = [at / partitions for at in range(1, partitions)]
    if not shares:
        return []
    (found,) = sample.agg(F.percentile_approx(column, shares, 100 * partitions)).first()
    return sorted(set(found or []))


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float, Decimal)) else f"'{value}'"


def parts(column: str, bounds: Sequence) -> list[str]:
    """Conditions for the ranges between the bounds, open at both ends, and for rows without a value."""
    texts = [_literal(bound) for bound in bounds]
    if not texts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]}", *inner, f"{column} >= {texts[-1]}", f"{column} IS NULL"]


@dataclass(frozen=True)
class Database:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = DRIVER
    fetch_size: int = FETCH_SIZE
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            **self.extra,
        }


def relation(table: str, watermark: str | None, *, inclusive: bool = False) -> str:
    """What to read: the table, or a subquery of its rows changed after the watermark."""
    if table not in TRACKED_TABLES or watermark is None:
        return table
    later = ">=" if inclusive else ">"
    return f"(SELECT * FROM {table} WHERE {VERSION} {later} '{watermark}') AS changed"


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    watermark: str | None = None,
    *,
    split: Split | Depths | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """The changed rows of a tracked table, or all rows of any other.

    The database evaluates the watermark. A large table needs a ``split``; without
    one it arrives through a single connection. ``Depths`` finds its parts by a sample; as they are open at both ends, rows that come
    after it are read as well.
    """
    dbtable = relation(table, watermark, inclusive=inclusive)
    if isinstance(split, Depths):
        sample = spark.read.format("jdbc").options(**database.options()).option("dbtable", split.sample(table)).load()
        properties = {name: value for name, value in database.options().items() if name != "url"}
        rows = spark.read.jdbc(database.url, dbtable, predicates=split.predicates(sample), properties=properties)
    else:
        options = database.options() | (split.options() if split else {})
        rows = spark.read.format("jdbc").options(**options).option("dbtable", dbtable).load()
    return click_table_as_files(rows) if table == "clickstream" else rows


def click_table_as_files(clicks: DataFrame) -> DataFrame:
    """The database's click table with the names and types of ingested click files."""
    renamed = clicks.withColumnsRenamed(CLICK_TABLE_RENAMES)
    return renamed.withColumns(
        {
            "price": F.col("price").cast("double"),
            "discount": F.col("discount").cast("double"),
            "is_returning": ~F.coalesce("is_new_user", F.lit(True)),
        }
    ).drop("is_new_user")
