"""Row numbers hold when a table is cut into other partitions between two jobs, as after the loss of an executor."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import exact_dedup as E
from cartwheel.llm import line_dedup as L
from cartwheel.llm import ngram_join as N
from cartwheel.llm import warc as W

CUT = "spark.sql.leafNodeDefaultParallelism"
LINES = "\n".join(" ".join(f"w{line}x{k}" for k in range(12)) for line in range(12))


@pytest.fixture
def docs(spark, folder):
    """Pairs of copies and texts of their own, in 8 files."""
    text = F.concat(F.lit(LINES), F.lit("\n"), F.repeat(F.concat(F.lit("own"), F.floor(F.col("id") / 2), F.lit(" ")), 60))
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, text).otherwise(F.concat(F.lit("alone "), F.col("id"))).alias("text"))
    rows.repartition(8, "doc_id").write.parquet(f"{folder}/docs")
    yield spark.read.parquet(f"{folder}/docs")
    spark.conf.unset(CUT)


def test_another_cut(spark, docs):
    spark.conf.set(CUT, "64")
    parts = docs.rdd.getNumPartitions()
    spark.conf.set(CUT, "1")
    assert spark.read.parquet(*docs.inputFiles()).rdd.getNumPartitions() < parts


def test_exact_dedup(spark, docs):
    spark.conf.set(CUT, "64")
    dedup = E.ExactDedup(docs)
    expected = sorted(r.doc_id for r in dedup.decisions().where("kept").collect())
    kept = dedup.kept_rows()
    spark.conf.set(CUT, "1")
    assert sorted(r.doc_id for r in kept.collect()) == expected


def test_ngram_join(spark, docs):
    spark.conf.set(CUT, "64")
    similar = N.SimilarDocuments(docs)
    expected = sorted({r.component_id for r in similar.components().collect()})
    spark.conf.set(CUT, "1")
    assert sorted(r.doc_id for r in similar.one_each().collect()) == expected


def test_line_dedup(spark, docs):
    spark.conf.set(CUT, "64")
    expected = Counter((r.doc.doc_id, r.n_removed) for r in L.dedup_lines(docs).collect())
    cleaned = L.dedup_lines(docs)
    spark.conf.set(CUT, "1")
    assert Counter((r.doc.doc_id, r.n_removed) for r in cleaned.collect()) == expected


def test_archives(spark, docs, folder, monkeypatch):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"))
    spark.conf.set(CUT, "64")

    def saved(df, purpose, *rest, save=W.saved):
        found = save(df, purpose, *rest)
        spark.conf.set(CUT, "1")
        return found

    monkeypatch.setattr(W, "saved", saved)
    W.write_archives(pages, f"{folder}/archives")
    found = W.resolved(W.read_archives(spark, f"{folder}/archives")).collect()
    texts = {r.page_id: r.html for r in pages.collect()}
    assert len(found) == 400 and all(r.verified for r in found)
    assert all(texts[r.page_id] == texts[r.refers_to] for r in found if r.record_type == "revisit")
