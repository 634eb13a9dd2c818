"""Exact de-duplication of documents by two Bloom filter passes.

Pass one hashes every text to one bit of a wide bit table and counts the rows per bit. A row that is
alone on its bit is proved to be unique. The few bits hit more than once are the items of a second,
compact Bloom filter of 4 KB blocks. Pass two probes every row against that filter: rows that miss it
pass straight through, and only the rest are shuffled and grouped by their SHA-256. The filters decide
which rows travel, never which are equal.

The second filter holds two bytes per repeated text. It is broadcast while that is at most
``FILTER_BYTES``; beyond it Spark joins the blocks by shuffle, with the same result.

Defined results: null text counts as empty; of equal texts the row with the largest id stays, a null id
being the smallest; among rows of that id, one stays (the last in reading order). Columns of any name may
be present, as they are never mixed with working columns. Rows are written once with their numbers.
Built of DataFrame functions only.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import saved, table

FILTER_BYTES = 64 << 20
BITS_PER_ROW = 64  # of the first pass: one unique row in 64 travels in vain
BITS_PER_REPEAT = 16  # of the second filter
PROBES = 4
BLOCK_BITS = 32768  # of one bitmap aggregate

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUTPUT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def text_sha256(text: Column) -> Column:
    return F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), 256)


def _bit(sha: Column, bits: int) -> Column:
    """The row's bit in the first pass."""
    return F.pmod(F.xxhash64(sha), F.lit(bits))


class RepeatFilter:
    """Tells which texts may occur more than once."""

    def __init__(self, shas: DataFrame, sha: str):
        self.bits = max(BLOCK_BITS, BITS_PER_ROW * shas.count())
        repeated = saved(
            shas.groupBy(_bit(F.col(sha), self.bits).alias("bit")).count().where("count > 1").select("bit"),
            "repeated-bits",
        )
        count = repeated.count()
        self.blocks = -(-BITS_PER_REPEAT * max(count, 1) // BLOCK_BITS)
        places = F.array(*[self._place(F.col("bit"), probe) for probe in range(PROBES)])
        self.table = (
            repeated.select(self._block(F.col("bit")).alias("block"), F.explode(places).alias("place"))
            .groupBy("block")
            .agg(F.bitmap_construct_agg("place").alias("bitmap"))
        )
        self.small = self.blocks * BLOCK_BITS // 8 <= FILTER_BYTES

    def _block(self, bit: Column) -> Column:
        return F.pmod(F.xxhash64(bit, F.lit(-1)), F.lit(self.blocks))

    @staticmethod
    def _place(bit: Column, probe: int) -> Column:
        return F.pmod(F.xxhash64(bit, F.lit(probe)), F.lit(BLOCK_BITS))

    def probe(self, rows: DataFrame, sha: str, found: str) -> DataFrame:
        """The rows with a column that is true where the text may be repeated."""
        blocks = F.broadcast(self.table) if self.small else self.table
        bit = _bit(F.col(sha), self.bits)

        def is_set(place: Column) -> Column:
            byte = F.substring("__bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))
            value = F.conv(F.hex(byte), 16, 10).cast("int")
            return F.getbit(value, (place % 8).cast("int")) == 1

        hit = F.lit(True)
        for probe in range(PROBES):
            hit = hit & is_set(self._place(bit, probe))
        return (
            rows.withColumn("__block", self._block(bit))
            .join(blocks.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")), "__block", "left")
            .withColumn(found, F.coalesce(hit, F.lit(False)))
            .drop("__block", "__bitmap")
        )


def _hashed(docs: DataFrame, text: str, columns: list[Column]) -> DataFrame:
    return docs.select(
        *columns, F.monotonically_increasing_id().alias("__row"), text_sha256(F.col(text)).alias("__sha")
    )


class ExactDedup:
    """Decisions on all rows of ``docs``, and the rows that stay."""

    def __init__(self, docs: DataFrame, *, text: str = "text", id: str = "doc_id"):
        self.docs, self.text, self.id = docs, text, id

    @cached_property
    def hashed(self) -> DataFrame:
        return saved(_hashed(self.docs, self.text, [F.col(self.id).alias("doc_id")]), "hashed")

    @cached_property
    def filter(self) -> RepeatFilter:
        return RepeatFilter(self.hashed.select("__sha"), "__sha")

    def _decisions(self, hashed: DataFrame, filter: RepeatFilter) -> tuple[DataFrame, DataFrame]:
        """Decisions on rows that travelled, and on those that passed straight through."""
        probed = filter.probe(hashed, "__sha", "__maybe")
        maybe = probed.where("__maybe")
        groups = maybe.groupBy("__sha").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "__row")).alias("keep")
        )
        groups = saved(groups, "groups")  # written, so that a group of many copies can be split in the join
        grouped = maybe.join(groups, "__sha").select(
            "doc_id",
            F.col("keep.doc_id").alias("keep_id"),
            "group_size",
            (F.col("__row") == F.col("keep.__row")).alias("kept"),
            F.col("__sha").alias("text_sha256"),
            "__row",
        )
        straight = probed.where("not __maybe").select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("bigint").alias("group_size"),
            F.lit(True).alias("kept"),
            F.col("__sha").alias("text_sha256"),
            "__row",
        )
        return grouped, straight

    def decisions(self) -> DataFrame:
        """A row for each document: doc_id, keep_id, group_size, kept, text_sha256."""
        grouped, straight = self._decisions(self.hashed, self.filter)
        return grouped.unionByName(straight).select(*OUTPUT)

    def kept_rows(self) -> DataFrame:
        """The rows that stay, with all their columns. Rows the filter clears are not shuffled."""
        whole = saved(_hashed(self.docs, self.text, [F.col(self.id).alias("doc_id"), F.struct("*").alias("__doc")]), "numbered")
        filter = RepeatFilter(whole.select("__sha"), "__sha")
        probed = filter.probe(whole, "__sha", "__maybe")
        dropped = self._decisions(whole.drop("__doc"), filter)[0].where("not kept").select("__row")
        rest = probed.where("__maybe").join(dropped, "__row", "left_anti")
        return probed.where("not __maybe").select("__doc.*").unionByName(rest.select("__doc.*"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ExactDedup(table(spark, sf_dir, "documents")).decisions()


SQL = f"""
WITH hashed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM hashed
WINDOW same AS (PARTITION BY text_sha256)
"""


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ExactDedup(docs).kept_rows()
