"""The key reports with bitmaps of whole-number keys, so that only rows that break something are shuffled.

A bitmap has a bit for every number; a row of it is a word of ``WORD`` neighbouring numbers. It is exact, unlike a
filter of hashes: a number whose bit is not set is no key. Keys that stand close to each other in a table share words, which are merged
before they are shuffled. Values that are not whole numbers take the plain way of ``quality``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.incremental.buckets import written_once
from cartwheel.model import FOREIGN_KEYS, PRIMARY_KEYS, REQUIRED_COLUMNS, UNIQUE_COLUMNS, ForeignKey
from cartwheel.operators.quality import fk_violations, key_violations, spread

WORD = 64
WORDS = 2_000_000  # words of a bitmap that may be broadcast, two numbers each
SUSPECTS = 200_000  # words with repeated keys that may be broadcast
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _word(key: Column) -> Column:
    return F.shiftright(key, WORD.bit_length() - 1)


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(WORD - 1)).cast("int"))


def _number(key: Column) -> Column:
    return key.try_cast("bigint")


def _text(key: Column) -> Column:
    """A value that is no whole number, as it is compared; NULL for one that is."""
    return F.when(_number(key).isNull(), F.trim(key.cast("string")))


def fk_violations_by_bitmap(
    tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey] = FOREIGN_KEYS, *, words: int = WORDS
) -> DataFrame:
    """What ``fk_violations`` reports. References are looked up in a bitmap of their parents' keys where they are read, and
    those that find their key go no further: a popular key costs nothing, and a clean table is not shuffled.

    The bitmap is written once and broadcast, up to ``words`` of its words; if the keys are so many or so scattered that
    it is larger, the values are counted and shuffled as ``fk_violations`` does.
    """
    checked = [fk for fk in foreign_keys if fk.child in tables and fk.parent in tables]
    if not checked:
        raise ValueError("no reference has both its tables")
    parents = {fk.parent: fk.parent_column for fk in checked}
    number = {parent: at for at, parent in enumerate(parents)}

    def place(parent: str, key: Column) -> Column:
        return _word(key) * len(parents) + number[parent]

    keys = [tables[parent].select(F.lit(parent).alias("parent"), F.col(column).alias("_value")) for parent, column in parents.items()]
    numbers = reduce(
        DataFrame.unionByName,
        [
            rows.select(place(parent, _number(F.col("_value"))).alias("place"), _bit(_number(F.col("_value"))).alias("bit"))
            for parent, rows in zip(parents, keys)
        ],
    )
    bitmap = written_once(numbers.where("place IS NOT NULL").groupBy("place").agg(F.bit_or("bit").alias("bits")), "key-bitmap")
    if bitmap.count() > words:
        return fk_violations(tables, checked)

    def entries(child: str) -> DataFrame:
        own = [
            F.struct(
                F.lit(at).alias("constraint"),
                F.lit(fk.parent).alias("parent"),
                place(fk.parent, _number(F.col(fk.column))).alias("place"),
                _bit(_number(F.col(fk.column))).alias("bit"),
                _number(F.col(fk.column)).alias("key"),
                _text(F.col(fk.column)).alias("text"),
            )
            for at, fk in enumerate(checked)
            if fk.child == child
        ]
        return tables[child].select(F.inline(F.array(*own))).where("key IS NOT NULL OR text IS NOT NULL")

    used = reduce(DataFrame.unionByName, [entries(child) for child in dict.fromkeys(fk.child for fk in checked)])
    looked_up = used.join(F.broadcast(bitmap), "place", "left")
    unknown = looked_up.where(F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) == 0, F.lit(True)))
    counts = [F.count_if(F.col("constraint") == at).alias(f"uses_{at}") for at in range(len(checked))]
    dangling = unknown.groupBy("parent", "key", "text").agg(*counts)
    texts = reduce(
        DataFrame.unionByName, [rows.select("parent", _text(F.col("_value")).alias("known")).where("known IS NOT NULL") for rows in keys]
    ).select(F.col("parent").alias("_parent"), "known")
    missing = dangling.join(texts, (F.col("parent") == F.col("_parent")) & (F.col("text") == F.col("known")), "left_anti")
    lines = [
        F.struct(
            F.lit(fk.name).alias("constraint"),
            F.lit(fk.parent).alias("parent_table"),
            F.coalesce(F.sum(f"uses_{at}"), F.lit(0)).alias("violations"),
            F.count_if(F.col(f"uses_{at}") > 0).alias("missing_keys"),
        )
        for at, fk in enumerate(checked)
    ]
    return missing.agg(F.array(*lines).alias("report")).select(F.inline("report"))


def key_violations_by_bitmap(
    tables: Mapping[str, DataFrame],
    primary_keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS,
    unique_columns: Mapping[str, Sequence[str]] = UNIQUE_COLUMNS,
    required_columns: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
) -> DataFrame:
    """What ``key_violations`` reports, primary keys that end in a whole number in two passes.

    The first counts the rows of each word and sets their bits: a word with as many bits as rows holds every key once. The second
    counts the keys of the other words one by one; where there are none, it reads nothing.
    """
    mapped = {
        table: key
        for table, key in primary_keys.items()
        if table in tables and isinstance(tables[table].schema[key[-1]].dataType, WHOLE)
    }
    others = {table: key for table, key in primary_keys.items() if table not in mapped}
    rest = {
        table: df
        for table, df in tables.items()
        if table in others or table in unique_columns or table in required_columns
    }
    reports = _two_passes(tables, mapped)
    if rest:
        reports.append(key_violations(rest, others, unique_columns, required_columns))
    return reduce(DataFrame.unionByName, reports)


def _cells(df: DataFrame, number: int, key: Sequence[str]) -> DataFrame:
    """Each row's word and bit in the bitmap of its table's keys; neither where a column is missing."""
    lead, last = [F.col(column).cast("string") for column in key[:-1]], F.col(key[-1]).cast("bigint")
    whole = reduce(lambda a, b: a & b, [F.col(column).isNotNull() for column in key])
    return spread(df.select(*key)).select(
        F.lit(number).alias("number"),
        whole.alias("whole"),
        F.when(whole, F.array(*lead, _word(last).cast("string"))).alias("cell"),
        F.when(whole, _bit(last)).alias("bit"),
        F.when(whole, last).alias("key"),
    )


def _two_passes(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> list[DataFrame]:
    """A report for each table; the first pass takes all tables together."""
    if not keys:
        return []
    cells = [_cells(tables[table], number, key) for number, (table, key) in enumerate(keys.items())]
    words = reduce(DataFrame.unionByName, cells).groupBy("number", "whole", "cell").agg(F.count("*").alias("n"), F.bit_or("bit").alias("bits"))
    marked = written_once(
        words.where(~F.col("whole") | (F.col("n") > F.bit_count("bits"))).select("number", "whole", "cell", "n"), "repeated-words"
    )
    found = marked.groupBy("number").agg(
        F.coalesce(F.sum(F.when(~F.col("whole"), F.col("n"))), F.lit(0)), F.count_if("whole")
    )
    counts = {number: (null_rows, suspects) for number, null_rows, suspects in found.collect()}
    zero, reports = F.lit(0).cast("bigint"), []
    for number, (table, key) in enumerate(keys.items()):
        null_rows, suspects = counts.get(number, (0, 0))
        head = [
            F.lit(table).alias("table_name"), F.lit("primary key").alias("kind"), F.lit(",".join(key)).alias("key_columns"),
            F.lit(null_rows).cast("bigint").alias("null_rows"),
        ]
        if not suspects:
            one = marked.sparkSession.range(1, numPartitions=1)
            reports.append(one.select(*head, zero.alias("repeated_keys"), zero.alias("excess_rows")))
            continue
        suspicious = marked.where((F.col("number") == number) & F.col("whole")).select("cell")
        suspicious = F.broadcast(suspicious) if suspects <= SUSPECTS else suspicious.hint("merge")
        copies = cells[number].where("whole").join(suspicious, "cell", "left_semi").groupBy("cell", "key").agg(F.count("*").alias("copies"))
        repeated = copies.where("copies > 1")
        summed = repeated.agg(F.count("*").alias("repeated_keys"), F.coalesce(F.sum(F.col("copies") - 1), zero).alias("excess_rows"))
        reports.append(summed.select(*head, "repeated_keys", "excess_rows"))
    return reports
