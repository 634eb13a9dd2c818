"""Counts against plain Python, robust estimates against random subsets and planted outliers."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm import outliers
from cartwheel.llm.outliers import COUNTS, FLOORS, SIZE, UNIT, chi_squared, estimates, judged, quantile, text_statistics

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def counted(text) -> tuple[int, ...]:
    text = text or ""
    words = SPLIT.findall(text)
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if SPLIT.search(line):
            lines += 1
            again += line in seen
            seen.add(line)
    runs = Counter(zip(words, words[1:], words[2:]))
    covered = {at + k for at, run in enumerate(zip(words, words[1:], words[2:])) if runs[run] > 1 for k in range(3)}
    letters = sum(letter.isascii() and letter.isalpha() or ord(letter) >= 0x80 for word in words for letter in word)
    symbols = sum(letter in "#*$%&|<>" for letter in text)
    return len(words), sum(map(len, words)), symbols, again, len(covered), lines, letters


def test_counts_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: tuple(r[name] for name in COUNTS) for r in text_statistics(docs).collect()}
    assert found == {r.doc_id: counted(r.text) for r in docs.collect()}


def test_counts_of_odd_documents(spark, odd_docs):
    texts = ["a\nb\na\n \n\na", "x x x x", "\n\n", "a b c a b c", "#a\n#a", "é\x0bé\x0cé", "a b c", "tail\n", "a b", "b c d\na b c d"]
    docs = odd_docs.selectExpr("doc_id", "text").unionByName(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ).selectExpr("doc_id", "text", "'en' AS lang", "CAST(NULL AS STRING) AS source").coalesce(1)
    rows = text_statistics(docs.selectExpr("doc_id", "text", "text AS lang", "source")).collect()
    assert [tuple(r[name] for name in COUNTS) for r in rows] == [counted(r.lang) for r in rows]


def test_distribution():
    assert abs(chi_squared(12.591587, 6) - 0.95) < 1e-6 and abs(quantile(0.975, 6) - 14.449375) < 1e-5
    assert abs(chi_squared(3.841459, 1) - 0.95) < 1e-6


def vectors(seed: int, count: int, shift: float = 0.0) -> np.ndarray:
    draw = np.random.default_rng(seed)
    mixed = draw.normal(size=(count, SIZE)) @ np.tril(np.ones((SIZE, SIZE))) / 2
    return np.rint((mixed + shift + 4) * UNIT).astype(int)


def frame(spark, groups: dict[str, np.ndarray]):
    rows = [(label, *map(int, row)) for label, values in groups.items() for row in values]
    return spark.createDataFrame(rows, "label string, " + ", ".join(f"x{at} bigint" for at in range(SIZE)))


def test_a_third_of_outliers_does_not_move_the_estimate(spark):
    """One group of clean rows, the same with a fifth of junk, and a tiny one of equal rows."""
    clean, junk = vectors(1, 1500), vectors(2, 375, shift=9)
    rows = frame(spark, {"clean": clean, "mixed": np.vstack([clean, junk]), "equal": np.full((120, SIZE), 700)})
    found = {r.label: r for r in estimates(rows.repartition(7)).collect()}
    own = np.cov(clean.T) + np.diag((np.array(FLOORS) * UNIT) ** 2)
    for label in ("clean", "mixed"):
        factor = np.zeros((SIZE, SIZE))
        factor[np.tril_indices(SIZE)] = found[label].factor
        assert np.abs(np.array(found[label].center) - clean.mean(0)).max() < 0.15 * UNIT
        ratio = np.linalg.eigvals(factor @ own @ factor.T).real
        assert 0.7 < ratio.min() and ratio.max() < 1.4  # both covariances are nearly the same
    assert found["equal"].center == [700.0] * SIZE
    again = {r.label: r for r in estimates(rows.coalesce(1)).collect()}
    assert found == again


def test_the_subset_has_a_smaller_determinant_than_random_ones(spark):
    """Plain concentration from many random starts finds no subset that is clearly better."""
    values = np.vstack([vectors(3, 400), vectors(4, 90, shift=4), vectors(5, 30, shift=-8)])
    floors = np.diag((np.array(FLOORS) * UNIT) ** 2)
    half = math.ceil(outliers.SUBSET * len(values))

    def size(chosen: np.ndarray) -> float:
        return np.linalg.slogdet(np.cov(values[chosen].T, bias=True) * outliers._consistency(half / len(values)) + floors)[1]

    def shrunk(chosen: np.ndarray) -> np.ndarray:
        for _ in range(20):
            off = values - values[chosen].mean(0)
            inverse = np.linalg.inv(np.cov(values[chosen].T, bias=True) * outliers._consistency(half / len(values)) + floors)
            chosen = np.argsort(np.einsum("ij,jk,ik->i", off, inverse, off), kind="stable")[:half]
        return chosen

    draw = np.random.default_rng(6)
    best = min(size(shrunk(draw.choice(len(values), SIZE + 2, replace=False))) for _ in range(60))
    found = estimates(frame(spark, {"one": values})).first()
    factor = np.zeros((SIZE, SIZE))
    factor[np.tril_indices(SIZE)] = found.factor
    off = values - np.array(found.center)
    inner = np.argsort(((off @ factor.T) ** 2).sum(1), kind="stable")[:half]
    assert size(inner) < best + 0.05


def test_verdicts(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = judged(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for row in rows:
        n, repeats = row.n_words, row.n_repeat_words
        assert row.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (row.kept and row.base_failed)
        assert row.kept == (not row.base_failed and (row.distance is None or row.distance <= quantile(outliers.REJECT, SIZE)))
    passed = [row for row in rows if not row.base_failed and row.doc_id in labels]
    good = [row.kept for row in passed if labels[row.doc_id]]
    poor = [row.kept for row in passed if not labels[row.doc_id]]
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.1 * len(poor)


@pytest.mark.parametrize("source", ["CAST(NULL AS STRING)", "'a'", "CONCAT('s', doc_id)"])
def test_odd_documents(spark, odd_docs, no_docs, source):
    """Null and tiny groups, columns that are named like the operator's own, and no documents."""
    clashing = odd_docs.selectExpr("doc_id", "text", "'en' AS lang", f"{source} AS source", "1 AS x0", "2 AS label", "3 AS center", "4 AS n_words")
    rows = judged(clashing).collect()
    assert len(rows) == odd_docs.count()
    assert all(row.label is None and row.kept == (not row.base_failed) for row in rows)
    assert judged(clashing.where("false")).collect() == []


def test_equal_documents_are_kept_together(spark):
    text = " ".join(f"word{at} some other thing{at}" for at in range(40))
    junk = " ".join(f"#{at} $%& <{at}>" for at in range(40))
    docs = spark.createDataFrame(
        [(at, text, "en", "a") for at in range(300)] + [(1000 + at, junk, "en", "a") for at in range(20)],
        "doc_id bigint, text string, lang string, source string",
    )
    assert {(r.doc_id < 1000, r.kept) for r in judged(docs).collect()} == {(True, True), (False, False)}
