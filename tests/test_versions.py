import datetime as dt

from pyspark.sql import functions as F

from cartwheel.operators.versions import (
    absent,
    current_snapshot,
    dedup,
    dedup_rare,
    insert_if_absent,
    new_rows,
    restamp,
    upsert_latest,
)

DAY = [dt.datetime(2024, 1, day) for day in range(1, 10)]


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_dedup_takes_highest_version_and_drops_missing_keys(spark):
    df = spark.createDataFrame(
        [(1, "old", DAY[0]), (1, "new", DAY[2]), (1, "never", None), (2, "only", None), (None, "lost", DAY[3])],
        "k INT, v STRING, updated_at TIMESTAMP",
    )
    assert rows(dedup(df, ("k",)).select("k", "v")) == [(1, "new"), (2, "only")]


def test_dedup_ties_fall_to_stamp_then_to_remaining_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", DAY[0], DAY[1]), (1, "b", DAY[0], DAY[2]), (2, "x", DAY[0], DAY[1]), (2, "y", DAY[0], DAY[1])],
        "k INT, v STRING, updated_at TIMESTAMP, _ingestion_ts TIMESTAMP",
    )
    assert rows(dedup(df, ("k",)).select("k", "v")) == [(1, "b"), (2, "y")]


def test_dedup_without_version_column(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k INT, v INT")
    assert rows(dedup(df, ("k",))) == [(1, 3)]


def test_dedup_composite_key_with_missing_part(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (1, 2, "c"), (1, 1, "d")], "a INT, b INT, v STRING")
    assert rows(dedup(df, ("a", "b"))) == [(1, 1, "d"), (1, 2, "c")]


def test_dedup_without_key_removes_equal_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k INT, v STRING")
    assert rows(dedup(df, ())) == [(1, "a"), (1, "b")]


def test_snapshot_over_batches(spark):
    first = spark.createDataFrame([(1, "old", DAY[0]), (2, "kept", DAY[0])], "k INT, v STRING, updated_at TIMESTAMP")
    second = spark.createDataFrame([(1, "new", DAY[1])], first.schema)
    late = spark.createDataFrame([(1, "newest, equal version", DAY[1])], first.schema)
    history = (
        restamp(first, "2024-02-01 00:00:00")
        .unionByName(restamp(late, "2024-02-03 00:00:00"))
        .unionByName(restamp(second, "2024-02-02 00:00:00"))
    )
    found = rows(current_snapshot(history, ("k",)).select("k", "v", "_ingestion_date"))
    assert found == [(1, "newest, equal version", "2024-02-03"), (2, "kept", "2024-02-01")]


def test_upsert_and_insert(spark):
    base = spark.createDataFrame([(1, "base", DAY[5]), (2, "base", DAY[0])], "k INT, v STRING, updated_at TIMESTAMP")
    incoming = spark.createDataFrame(
        [(1, "in", DAY[0]), (1, "in later", DAY[1]), (3, "in", DAY[0]), (None, "lost", DAY[0])], base.schema
    )
    assert rows(upsert_latest(base, incoming, ("k",)).select("k", "v")) == [(1, "in later"), (2, "base"), (3, "in")]
    assert rows(insert_if_absent(base, incoming, ("k",)).select("k", "v")) == [(1, "base"), (2, "base"), (3, "in")]
    assert rows(absent(base, incoming, ("k",)).select("k", "v")) == [(3, "in")]


def test_many_versions_of_one_key_are_cut_before_the_shuffle(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("updated_at")
    )
    latest = dedup(df, ("k",))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.where("k = 0").first().updated_at == 199_998
    assert latest.count() == 133_334


def test_snapshot_reads_only_selected_columns(spark, folder):
    wide = spark.range(100).select(
        F.col("id").alias("k"), F.lit("x").alias("wide"), F.lit(1).alias("n"),
        F.lit("2024-01-01").cast("timestamp").alias("_ingestion_ts"),
    )
    wide.write.parquet(f"{folder}/t")
    narrow = spark.read.parquet(f"{folder}/t").select("k", "n", "_ingestion_ts")
    plan = current_snapshot(narrow, ("k",))._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan.split("ReadSchema")[1]


def test_snapshot_of_batches_with_equal_stamps_holds_each_key_once(spark):
    batches = [spark.createDataFrame([(1, value, DAY[0])], "k INT, v STRING, updated_at TIMESTAMP") for value in ("old", "new")]
    for order in (batches, batches[::-1]):
        history = restamp(order[0], "2024-02-01 00:00:00").unionByName(restamp(order[1], "2024-02-01 00:00:00"))
        assert rows(current_snapshot(history, ("k",)).select("k", "v")) == [(1, "old")]


def test_dedup_rare_equals_dedup(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = lines.withColumn("l_linenumber", F.expr("IF(l_partkey % 10 = 0, NULL, l_linenumber)"))
    keys = ("l_orderkey", "l_linenumber")
    found = dedup_rare(lines, keys, version="l_shipdate", stamp=None)
    assert found.columns == lines.columns
    assert rows(found) == rows(dedup(lines, keys, version="l_shipdate", stamp=None))


def test_dedup_rare_runs_no_job_while_it_is_built(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("rare", "")
    try:
        found = dedup_rare(spark.range(1000).selectExpr("IF(id % 3 = 0, 1, id) AS k", "id AS updated_at"), ("k",))
        assert not jobs("rare")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert found.count() == 666 and found.where("k = 1").first().updated_at == 999


def test_new_rows_compare_nulls(spark):
    known = spark.createDataFrame([(1, None), (None, "a")], "k INT, v STRING")
    incoming = spark.createDataFrame([(1, None), (1, None), (1, "x"), (None, "a"), (None, "b"), (None, "b")], "k INT, v STRING")
    assert sorted(map(repr, new_rows(known, incoming, ("k", "v")).collect())) == ["Row(k=1, v='x')", "Row(k=None, v='b')"]
