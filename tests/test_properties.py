"""The text rules on generated strings, against Python's regular expressions."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.functions import text
from cartwheel.functions.numeric import at_least, percent

ALPHABET = "aZ09 .@-_+%#\t"


def strings(seed, count=3000, longest=22):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(count)]


def rule(spark, column_rule, values):
    df = spark.createDataFrame(list(enumerate(values)), "i INT, v STRING")
    return [row.out for row in df.select("i", column_rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_email_rule(spark):
    pattern = re.compile(r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}")
    values = strings(1) + [f"{a.strip()}@x{b.strip()}.aZ" for a, b in zip(strings(2, 500, 6), strings(3, 500, 6))]
    expected = [value.lower() if pattern.fullmatch(value.lower()) else None for value in values]
    assert any(expected)
    assert rule(spark, text.email_or_null, values) == expected


def test_phone_rule(spark):
    values = [value.replace("a", "7").replace("Z", "3") for value in strings(4, longest=40)]
    digits = [re.sub(r"[^0-9]", "", value) for value in values]
    expected = [number if 9 <= len(number) <= 15 else None for number in digits]
    assert any(expected)
    assert rule(spark, text.phone_or_null, values) == expected


def test_blank_rule(spark):
    values = strings(5, longest=5)
    assert rule(spark, text.blank_to_null, values) == [value.strip(" ") or None for value in values]


def test_id_rule(spark):
    rng = random.Random(6)
    values = ["".join(rng.choice("0123456789") for _ in range(rng.randrange(1, 24))) for _ in range(2000)]
    expected = [int(value) if int(value) < 2**63 else None for value in values]
    assert rule(spark, text.id_or_null, values) == expected


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=200))
def test_percent(spark, pairs):
    df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i INT, part BIGINT, whole BIGINT")
    found = df.select("i", percent(F.col("part"), F.col("whole")).alias("p")).orderBy("i").collect()
    for row, (part, whole) in zip(found, pairs):
        exact = part / whole * 100 if whole else 0.0
        assert abs(row.p - exact) <= 0.005 + exact * 1e-12


def test_steps(spark):
    df = spark.range(0, 20).select("id", at_least(F.col("id"), ((10, 5), (5, 4), (3, 3), (2, 2)), 1).alias("s"))
    assert [row.s for row in df.orderBy("id").collect()] == [1, 1, 2, 3, 3] + [4] * 5 + [5] * 10
