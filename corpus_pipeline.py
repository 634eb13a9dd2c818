"""Documents to packed training sequences, in stages; each one's rows are written before the next begins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.exact_dedup import exact_stage
from cartwheel.llm.ngram_join import near_stage
from cartwheel.llm.packing import digests, packing_stage
from cartwheel.llm.pii import pii_stage
from cartwheel.llm.quality import quality_stage
from cartwheel.llm.tables import saved, table

STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("PII", pii_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a tokenizer are not SQL; the tests hold the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces, with a checksum in place of their ids."""
    return digests(run(spark, sf_dir))
