"""Constraint and validity reports over whole tables.

All reports count values before they are shuffled, so one very frequent value
(a popular product, an unset column) travels as one row per task. As most keys are
rare, a task holds nearly as many counts as it has rows; larger tables are therefore
dealt to more tasks first, see ``spread``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import text
from cartwheel.model import (
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    REQUIRED_COLUMNS,
    UNIQUE_COLUMNS,
    ForeignKey,
)


PART = 4 << 20  # bytes of a table's files whose rows are counted in one task
MOST_PARTS = 8192  # beyond that tasks grow and Spark spills
UNKNOWN = 1 << 62  # bytes; of a table in a database Spark knows no size and takes a larger one


def spread(rows: DataFrame, *, part: int | None = None) -> DataFrame:
    """The same rows in as many tasks as the size of their files asks for, so that what a task counts does not grow with the table.

    Equal rows that were read by one task stay together, and those of several tasks apart: they are counted as well as before, and no task
    gets all rows of a frequent value. Rows that do not come from files, or from small ones, stay where they are.
    """
    part = part or PART
    parts = min(-(-_file_bytes(rows) // part), MOST_PARTS)
    return rows.repartition(parts, F.spark_partition_id(), *(F.col(f"`{name}`") for name in rows.columns)) if parts > 1 else rows


def _file_bytes(rows: DataFrame) -> int:
    """The size of the files that rows are read from, which Spark knows when it has planned them."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    relations = [leaf for leaf in map(leaves.apply, range(leaves.size())) if leaf.nodeName() == "LogicalRelation"]
    sizes = [int(str(relation.stats().sizeInBytes())) for relation in relations]
    return sum(size for size in sizes if size < UNKNOWN)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def fk_violations(
    tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey] = FOREIGN_KEYS
) -> DataFrame:
    """Per reference: how many child rows point at no parent, and at how many missing keys.

    A NULL reference is allowed. Keys may be of any type: numbers written differently agree, and a value that is
    no number is compared as text, so a malformed reference counts as one to a missing key. Each child table is read once for all its
    references, each parent once for its key.
    """
    checked = [fk for fk in foreign_keys if fk.child in tables and fk.parent in tables]
    if not checked:
        raise ValueError("no reference has both its tables")
    children = [_references(tables[child], [fk for fk in checked if fk.child == child])
                for child in dict.fromkeys(fk.child for fk in checked)]
    parents = [
        tables[fk.parent].select(
            F.lit(fk.parent).alias("parent_table"),
            _comparable(F.col(fk.parent_column)).alias("value"),
        )
        for fk in {fk.parent: fk for fk in checked}.values()
    ]
    # One row per value and parent, with a counter for each reference, is partitioned as the join is.
    used = _union(children).groupBy("parent_table", "value").agg(
        *(F.count_if(F.col("constraint") == fk.name).alias(f"uses_{i}") for i, fk in enumerate(checked))
    )
    dangling = used.join(_union(parents), ["parent_table", "value"], "left_anti")
    lines = [
        F.struct(
            F.lit(fk.name).alias("constraint"),
            F.lit(fk.parent).alias("parent_table"),
            F.coalesce(F.sum(f"uses_{i}"), F.lit(0)).alias("violations"),
            F.count_if(F.col(f"uses_{i}") > 0).alias("missing_keys"),
        )
        for i, fk in enumerate(checked)
    ]
    return dangling.agg(F.array(*lines).alias("report")).select(F.inline("report"))


def _comparable(key: Column) -> Column:
    return F.coalesce(key.try_cast("bigint").cast("string"), F.trim(key.cast("string")))


def _references(child: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(fk.name).alias("constraint"),
            F.lit(fk.parent).alias("parent_table"),
            _comparable(F.col(fk.column)).alias("value"),
        )
        for fk in keys
    ]
    own = spread(child.select(*dict.fromkeys(fk.column for fk in keys)))
    return own.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def key_violations(
    tables: Mapping[str, DataFrame],
    primary_keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS,
    unique_columns: Mapping[str, Sequence[str]] = UNIQUE_COLUMNS,
    required_columns: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
) -> DataFrame:
    """Per PRIMARY KEY, UNIQUE and NOT NULL constraint: what breaks it. Each table is read once.

    ``null_rows`` lack a value (unique columns may), ``repeated_keys`` are the
    values that occur more than once and ``excess_rows`` their rows beyond the first.
    """
    checks: dict[str, list[tuple[str, Sequence[str]]]] = {}
    for kind, constraints in (("primary key", primary_keys), ("unique", unique_columns), ("not null", required_columns)):
        for table, columns in constraints.items():
            for key in [columns] if kind == "primary key" else [(column,) for column in columns]:
                checks.setdefault(table, []).append((kind, key))
    return _union([_key_reports(tables[table], table, kinds) for table, kinds in checks.items() if table in tables])


def _key_reports(df: DataFrame, table: str, checks: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """All constraints of a table from one scan: its values are counted per constraint, then summed up."""
    entries = []
    for number, (kind, key) in enumerate(checks):
        incomplete = reduce(lambda a, b: a | b, [F.col(column).isNull() for column in key])
        # whether a required column is filled is all that is counted of it
        values = [F.col(column).cast("string") for column in key] if kind != "not null" else [F.lit("")]
        entries.append(
            F.struct(
                F.lit(number).alias("number"),
                F.when(~incomplete, F.array(*values)).alias("value"),
            )
        )
    own = spread(df.select(*dict.fromkeys(column for _, key in checks for column in key)))
    copies = own.select(F.inline(F.array(*entries))).groupBy("number", "value").agg(F.count("*").alias("copies"))
    reports = []
    for number, (kind, key) in enumerate(checks):
        own, repeated = F.col("number") == number, F.col("value").isNotNull() & (F.col("copies") > 1) & F.lit(kind != "not null")
        reports.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(kind).alias("kind"),
                F.lit(",".join(key)).alias("key_columns"),
                F.coalesce(F.sum(F.when(own & F.col("value").isNull(), F.col("copies"))), F.lit(0)).alias("null_rows"),
                F.count_if(own & repeated).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(own & repeated, F.col("copies") - 1)), F.lit(0)).alias("excess_rows"),
            )
        )
    return copies.agg(F.array(*reports).alias("report")).select(F.inline("report"))


def email_phone_quality(users: DataFrame) -> DataFrame:
    """One row per contact column: how many values are missing, valid and invalid."""
    raw = {"email": text.email_or_null, "phone": text.phone_or_null}
    counts = []
    for name, rule in raw.items():
        value = text.blank_to_null(F.col(name))
        counts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count("*").alias("total_rows"),
                F.count_if(value.isNull()).alias("missing"),
                F.count_if(rule(value).isNotNull()).alias("valid"),
                F.count_if(value.isNotNull() & rule(value).isNull()).alias("invalid"),
            )
        )
    return users.agg(F.array(*counts).alias("report")).select(F.inline("report"))
