"""Exact de-duplication against its SQL and a plain grouping."""

import hashlib
from collections import defaultdict

import duckdb
import pytest

from cartwheel.llm import exact_dedup as E
from cartwheel.llm.queries import QUERIES

FOLD = str.maketrans(E.UPPER, E.LOWER)


def sha(text):
    return hashlib.sha256((text or "").translate(FOLD).encode()).hexdigest()


def plain(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, sorted."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[sha(text)].append(doc_id)
    keep = {key: max(ids, key=lambda i: (i is not None, i or 0)) for key, ids in groups.items()}
    return sorted(map(repr, ((i, keep[sha(t)], len(groups[sha(t)]), sha(t)) for i, t in rows)))


def decided(rows):
    return sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows)))


def test_query_matches_its_sql(spark, sf_dir):
    found = QUERIES["op1_exact_dedup"](spark, sf_dir).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
        assert sorted(map(tuple, found.collect())) == sorted(connection.execute(E.SQL).fetchall())


def test_odd_documents(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    dedup = E.ExactDedup(odd_docs)
    found = dedup.decisions().collect()
    assert decided(found) == plain(rows)
    shas = {r.text_sha256 for r in found}
    assert sorted(r.text_sha256 for r in found if r.kept) == sorted(shas)  # one of each group, ties included
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    kept = dedup.kept_rows()
    assert kept.columns == odd_docs.columns
    assert sorted(sha(r.text) for r in kept.collect()) == sorted(shas)


def test_empty_table(no_docs):
    dedup = E.ExactDedup(no_docs)
    assert dedup.decisions().collect() == [] and dedup.kept_rows().collect() == []


@pytest.mark.parametrize("limit", [0, E.FILTER_BYTES])
def test_hot_group_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(E, "FILTER_BYTES", limit)
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'Same', concat('own ', id)) as text")
    dedup = E.ExactDedup(docs)
    assert decided(dedup.decisions().collect()) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert dedup.kept_rows().count() == 4001


def test_filter_clears_most_unique_rows(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id < 200, 'copy', concat('own ', id)) as text")
    dedup = E.ExactDedup(docs)
    maybe = dedup.filter.probe(dedup.hashed, "__sha", "maybe").where("maybe").count()
    assert 200 <= maybe < 200 + 0.05 * 20_000


def test_plan_is_native_and_rows_cleared_are_not_shuffled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = E.ExactDedup(docs).kept_rows()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
