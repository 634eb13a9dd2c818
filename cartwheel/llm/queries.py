"""The operators as queries on the test tables, and plain SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import (
    alignment,
    exact_dedup,
    license_scan,
    line_dedup,
    neighbours,
    ngram_join,
    outliers,
    packing,
    pii,
    quality,
    sentencepieces,
    spelling,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_neighbours": neighbours.op2_neighbours,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_pii": pii.op5_pii,
    "op6_quality": quality.op6_quality,
    "op7_packing": packing.op7_packing,
    "op8_sentencepiece": sentencepieces.op8_sentencepiece,
    "op9_warc": warc.op9_warc,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_spelling": spelling.op11_spelling,
    "op12_alignment": alignment.op12_alignment,
    "op13_quality_rules": outliers.op13_quality_rules,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
}
