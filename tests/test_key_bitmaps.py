"""The reports by bitmaps against those by grouping, and what they shuffle."""

import random

import pytest

from cartwheel.model import PRIMARY_KEYS, ForeignKey, table_schema
from cartwheel.operators.key_bitmaps import fk_violations_by_bitmap, key_violations_by_bitmap
from cartwheel.operators.quality import fk_violations, key_violations
from verification.adapters import view

KEYS = (ForeignKey("orders", "user_id", "users"), ForeignKey("order_items", "order_id", "orders"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def tables(spark, seed, kind="bigint"):
    draw = random.Random(seed)
    span = [draw.choice([-(2**62), -1000, 0, 10**12]) + draw.randrange(300) for _ in range(200)]
    users = [(value,) for value in draw.sample(span, 150)] + [(None,)]
    orders = [(at, draw.choice(span) if draw.random() < 0.9 else None) for at in range(300)]
    items = [(at % 50, draw.randrange(-5, 320)) for at in range(500)]
    made = {"users": (users, f"user_id {kind}"), "orders": (orders, f"order_id int, user_id {kind}"), "order_items": (items, "order_item_id int, order_id int")}
    if kind == "string":
        made = {name: ([tuple(None if value is None else draw.choice(["", " ", "u-"])[: at * 9] + str(value) if at == len(row) - 1 and name != "order_items" else value for at, value in enumerate(row)) for row in content], schema) for name, (content, schema) in made.items()}
    return {name: spark.createDataFrame(content, schema) for name, (content, schema) in made.items()}


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("words", [0, 2_000_000])
def test_references(spark, kind, words):
    for seed in range(3):
        made = tables(spark, seed, kind)
        assert rows(fk_violations_by_bitmap(made, KEYS, words=words)) == rows(fk_violations(made, KEYS))


def test_keys(spark):
    draw = random.Random(7)
    made = {
        "orders": spark.createDataFrame([(draw.randrange(-200, 200) if draw.random() < 0.95 else None,) for _ in range(300)], "order_id int"),
        "users": spark.createDataFrame([(at, f"e{at % 40}") for at in range(60)], "user_id bigint, email string"),
        "order_promotions": spark.createDataFrame(
            [(draw.choice([1, 2, None]), draw.choice([*range(60, 140), None])) for _ in range(100)], "order_id int, promo_id int"
        ),
        "categories": spark.createDataFrame([("a", None), ("a", "n"), ("b", "n")], "category_id string, category_name string"),
    }
    assert rows(key_violations_by_bitmap(made)) == rows(key_violations(made))
    empty = {table: spark.createDataFrame([], table_schema(table)) for table in PRIMARY_KEYS}
    assert rows(key_violations_by_bitmap(empty)) == rows(key_violations(empty))


def shuffled_rows(df) -> int:
    """Rows that the finished plan of ``df`` wrote to shuffles."""
    df.collect()
    total, seen, todo = 0, set(), [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.id() in seen:
            continue
        seen.add(node.id())
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            total += metric.get().value()
        children = node.children()
        todo += [children.apply(at) for at in range(children.size())]
    return total


def test_clean_references_are_not_shuffled(spark):
    """All of 40,000 references to 500 users, a third of them to one, and a few that dangle."""
    users = spark.range(500).selectExpr("CAST(id AS INT) AS user_id")
    orders = spark.range(40_000, numPartitions=8).selectExpr(
        "CAST(id AS INT) AS order_id", "CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 1000 = 1 THEN 900 + id ELSE id % 500 END AS INT) AS user_id"
    )
    report = fk_violations_by_bitmap({"users": users, "orders": orders}, KEYS[:1])
    assert rows(report) == rows(fk_violations({"users": users, "orders": orders}, KEYS[:1]))
    assert 0 < shuffled_rows(fk_violations_by_bitmap({"users": users, "orders": orders}, KEYS[:1])) < 0.05 * 40_000


def test_reports_of_the_test_tables(spark, sf_dir):
    made = {table: view(spark, sf_dir, f"c_{table}") for table in PRIMARY_KEYS}
    assert rows(fk_violations_by_bitmap(made)) == rows(fk_violations(made))
    assert rows(key_violations_by_bitmap(made)) == rows(key_violations(made))
