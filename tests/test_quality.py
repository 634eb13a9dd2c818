import pytest
from pyspark.sql import functions as F

from cartwheel.model import FOREIGN_KEYS, PRIMARY_KEYS, TABLE_DDL, declared_ids, table_schema
from cartwheel.operators import key_bitmaps, quality
from cartwheel.operators.key_bitmaps import key_violations_by_bitmap
from cartwheel.operators.quality import email_phone_quality, fk_violations, key_violations


def empty_tables(spark):
    return {table: spark.createDataFrame([], table_schema(table)) for table in TABLE_DDL}


def test_model_is_consistent(spark):
    assert set(TABLE_DDL) == set(PRIMARY_KEYS)
    for table, key in PRIMARY_KEYS.items():
        assert set(key) <= set(table_schema(table).names)
    for fk in FOREIGN_KEYS:
        assert fk.column in table_schema(fk.child).names
    assert "session_id" not in declared_ids()


def test_empty_tables_break_nothing(spark):
    tables = empty_tables(spark)
    report = fk_violations(tables).collect()
    assert len(report) == len(FOREIGN_KEYS) == 12
    assert all((row.violations, row.missing_keys) == (0, 0) for row in report)
    assert len(key_violations(tables).collect()) == len(PRIMARY_KEYS) + 1 + 2


def test_dangling_references(spark):
    tables = {
        "orders": spark.createDataFrame([(1, 5), (2, 6), (3, 6), (4, 7), (5, None)], "order_id INT, user_id INT"),
        "users": spark.createDataFrame([(5,)], "user_id INT"),
    }
    (row,) = fk_violations(tables).collect()
    assert (row.constraint, row.violations, row.missing_keys) == ("orders.user_id", 3, 2)


def test_no_reference_to_check(spark):
    with pytest.raises(ValueError):
        fk_violations({"users": spark.createDataFrame([(5,)], "user_id INT")})


def test_keys(spark):
    tables = {
        "order_promotions": spark.createDataFrame(
            [(1, 1), (1, 1), (1, 1), (1, 2), (2, None), (2, None)], "order_id INT, promo_id INT"
        ),
        "users": spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "user_id INT, email STRING"),
    }
    found = {(row.table_name, row.kind): tuple(row)[3:] for row in key_violations(tables).collect()}
    assert found == {
        ("order_promotions", "primary key"): (2, 1, 2),
        ("users", "primary key"): (0, 0, 0),
        ("users", "unique"): (2, 1, 1),
    }


def test_required_columns(spark):
    tables = {"products": spark.createDataFrame([(1, None), (2, "p")], "product_id INT, product_name STRING")}
    found = {row.kind: row.null_rows for row in key_violations(tables).collect()}
    assert found == {"primary key": 0, "not null": 1}


def test_contact_quality(spark):
    users = spark.createDataFrame(
        [("a@x.org", "12345678"), (" A@X.ORG ", "+84 90 123 4567"), ("nope", " "), (None, None)],
        "email STRING, phone STRING",
    )
    found = {row.column_name: tuple(row)[1:] for row in email_phone_quality(users).collect()}
    assert found == {"email": (4, 1, 2, 1), "phone": (4, 2, 1, 1)}


def test_a_larger_table_is_counted_by_more_tasks(spark, folder, monkeypatch):
    """Files of one task, some keys missing, repeated or dangling: the reports agree, in tasks of few rows each."""
    key = F.when(F.col("id") % 50 != 0, F.col("id") - F.col("id") % 40 % 2).cast("int")
    orders = spark.range(40_000, numPartitions=1).select(key.alias("order_id"), (F.col("id") % 3000).cast("int").alias("user_id"))
    orders.write.parquet(f"{folder}/orders")
    tables = {"orders": spark.read.parquet(f"{folder}/orders"), "users": spark.range(2500).selectExpr("CAST(id AS int) AS user_id", "'e' AS email")}

    def reports():
        found = [report(tables) for report in (fk_violations, key_violations, key_violations_by_bitmap)]
        plans = [report._jdf.queryExecution().optimizedPlan().toString() for report in found]
        return [sorted(map(tuple, report.collect())) for report in found], plans

    whole, plans = reports()
    assert quality.spread(tables["orders"]) is tables["orders"] and not any("RepartitionByExpression" in plan for plan in plans)
    monkeypatch.setattr(quality, "PART", 16 << 10)
    parts = quality.spread(tables["orders"])
    rows = [row.n for row in parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(rows) > 8 and max(rows) < 40_000 / 4
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, tables["orders"].collect()))
    split, plans = reports()
    assert split == whole and all("RepartitionByExpression" in plan for plan in plans)
    monkeypatch.setattr(key_bitmaps, "SUSPECTS", 0)
    assert reports()[0] == whole
