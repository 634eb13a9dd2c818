"""Two runs with half the data and changed rows in between lead to the same outputs as one run."""

from pyspark.sql import functions as F

from cartwheel.plans.layers import GROUPS, run_pipeline
from cartwheel.sources.files import changed_since, parquet
from verification.adapters import run, view
from verification.inputs import CLICK_ROWS

HALF = {table: "1998-07-01 00:00:00" for table in ("orders", "order_items", "order_promotions", "inventory")}
CHANGED_AT = "2030-01-01 00:00:00"


def changed(rows, table):
    """Rows as they are after a later change: every third order and user has new values."""
    stale = {"orders": F.col("order_id") % 3 == 0, "users": F.col("user_id") % 3 == 0}.get(table)
    if stale is None:
        return rows
    later = F.lit(CHANGED_AT).cast(rows.schema["updated_at"].dataType)
    values = {"updated_at": F.when(stale, later).otherwise(F.col("updated_at"))}
    if table == "orders":
        values["status"] = F.when(stale, "Refunded").otherwise(F.col("status"))
    else:
        values["full_name"] = F.when(stale, F.concat(F.lit("new "), "full_name")).otherwise(F.col("full_name"))
    return rows.withColumns(values)


def write_clicks(spark, sf_dir, folder, part, name):
    rows = run(spark, sf_dir, CLICK_ROWS).where(part)
    rows.coalesce(1).write.mode("append").csv(f"{folder}/{name}")


def content(spark, root, name):
    return sorted(map(repr, parquet(spark, f"{root}/gold/{name}").collect()))


def test_two_runs_equal_one(spark, sf_dir, folder):
    first = F.col("event_id") % 2 == 0
    # The second half brings some events of the first half once more.
    for part, name in ((first, "twice"), (F.lit(True), "once")):
        write_clicks(spark, sf_dir, folder, part, name)

    def early(table, watermark):
        rows = view(spark, sf_dir, f"c_{table}")
        rows = rows.where(F.col("updated_at") <= F.lit(HALF[table]).cast("timestamp_ntz")) if table in HALF else rows
        return changed_since(rows, "updated_at", watermark)

    def late(table, watermark):
        return changed_since(changed(view(spark, sf_dir, f"c_{table}"), table), "updated_at", watermark)

    def report(source, root, clicks):
        found = run_pipeline(spark, source, f"{folder}/{root}", click_path=f"{folder}/{clicks}", as_of="2001-08-01")
        return {(row.layer, row.table_name): row.row_count for row in found.collect()}

    report(early, "two", "twice")
    write_clicks(spark, sf_dir, folder, ~first | (F.col("event_id") % 10 == 0), "twice")
    two = report(late, "two", "twice")
    one = report(late, "one", "once")

    assert two["silver", "orders"] > one["silver", "orders"]
    assert two["silver", "clickstream"] > one["silver", "clickstream"]
    outputs = [name for group in GROUPS.values() for name in group]
    assert {name: two["gold", name] for name in outputs} == {name: one["gold", name] for name in outputs}
    for name in outputs:
        assert content(spark, f"{folder}/two", name) == content(spark, f"{folder}/one", name), name
