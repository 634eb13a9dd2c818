"""Quality of documents by ordinal cumulative-link regression on graded ratings.

The rating of a labelled document is 0 (low quality), 1 (fair text, but toxic) or 2 (good). One weight
vector over hashed text features is shared by all grades, and ordered thresholds cut its score:

    P(grade > k) = sigmoid(weights . features - threshold[k]),   threshold[0] < threshold[1]

From these come the expected grade and the tail probability P(grade = 2), which selects documents: it must reach ``KEEP``,
whatever the labels are. A text that nothing speaks against (its score is 0 or more) stays as well, so that few labels, or few good ones among them, do
not make all documents go.
Features are the distinct words of the whole text, their beginnings and endings, and how often words
repeat, hashed to ``DIMENSIONS`` places. A place has a weight if at least ``MIN_DOCS`` sample documents have it
and its share in a lower grade exceeds that in the top grade by ``MIN_Z`` standard errors: what speaks against
a text is added up, and a long clean text gathers no noise.

The model is fitted on at most ``SAMPLE`` labelled documents, the first by a hash of their id; their
features, of one row for each id, are gathered on the driver, which bounds it. Everything else covers all rows.

Defined results: null text counts as empty; a text without words scores 0; without any usable label all
documents score alike and are kept. Rows are independent, so ties and repeated rows score alike. A label
with a null id or a null grade is not used; of several labels of a document the lowest grade counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import words
from cartwheel.llm.tables import in_arrow, small_batches, table

SAMPLE = 8000
DIMENSIONS = 1 << 18
MIN_DOCS = 5
MIN_Z = 6.0
GRADES = 3
HEADS, TAIL = (4, 5), 3  # bytes of a word's beginning and ending
SCALE = 0.5  # of a feature's value, which keeps the score of a long text in range
RIDGE = 1e-5
STEPS, RATE = 150, 0.1
KEEP = 0.7  # least probability of the top grade; clean texts lie well above it

SCORES = "score double, expected_grade double, p_top double"


def text_features(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The distinct feature places of each text, or those of them that are ``wanted``."""
    blank = words.separators(words.BLANKS)
    for begin, end in words.slices(column):
        data, offsets = words.text_bytes(column.slice(begin, end - begin))
        starts, stops, before = words.spans(data, offsets, blank)
        kinds = [words.hashes(data, starts, stops, fold=True)]
        kinds += [words.hashes(data, starts, np.minimum(starts + head, stops), fold=True) for head in HEADS]
        kinds += [words.hashes(data, np.maximum(stops - TAIL, starts), stops, fold=True)]
        places = [_place(kind * np.uint64(2 * salt + 1)) for salt, kind in enumerate(kinds)]
        for row in range(end - begin):
            low, high = before[row], before[row + 1]
            if low == high:
                yield np.zeros(0, np.int32)
                continue
            distinct = len(np.unique(places[0][low:high]))
            repeats = np.array([20 * distinct // (high - low) + 32 * int(high - low).bit_length()], dtype=np.uint64)
            own = [place[low:high] for place in places]
            found = np.concatenate([*own, _place(repeats + np.uint64(1 << 40))])
            yield np.unique(found if wanted is None else found[wanted[found]])


def _place(hashed: np.ndarray) -> np.ndarray:
    return (words.mix(hashed) % np.uint64(DIMENSIONS)).astype(np.int32)


def _telling(features: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """The places that are commoner in a lower grade than in the top one."""
    sizes = np.bincount(grades, minlength=GRADES)
    held = []
    for grade in range(GRADES):
        rows = [row for row, given in zip(features, grades) if given == grade]
        held.append(np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=DIMENSIONS))
    telling, top = np.zeros(DIMENSIONS, dtype=bool), GRADES - 1
    for low in range(top):
        if sizes[low] and sizes[top]:
            share = (held[low] + held[top] + 1) / (sizes[low] + sizes[top] + 2)
            error = np.sqrt(share * (1 - share) * (1 / sizes[low] + 1 / sizes[top]))
            telling |= held[low] / sizes[low] - held[top] / sizes[top] >= MIN_Z * error
    return np.flatnonzero(telling & (sum(held) >= MIN_DOCS))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        features = text_features(column, self.weights != 0)
        return np.array([SCALE * self.weights[places].sum() for places in features], dtype=np.float64)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and k."""
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds[None, :])))


def fit(features: list[np.ndarray], grades: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam over the whole sample; no randomness."""
    steps = GRADES - 1
    if not len(features):
        return OrdinalModel(np.zeros(DIMENSIONS), np.full(steps, -10.0))
    used = _telling(features, grades)
    places = np.full(DIMENSIONS, -1)
    places[used] = np.arange(len(used))
    kept = [row[row >= 0] for row in (places[f] for f in features)]
    column = np.concatenate(kept) if kept else np.zeros(0, int)
    row = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    above = grades[:, None] > np.arange(steps)[None, :]
    share = (above.sum(0) + 0.5) / (len(grades) + 1)
    first = -np.log(share / (1 - share))
    # thresholds are first + positive gaps, which keeps them in order
    gap = np.log(np.expm1(np.maximum(np.diff(first), 1e-2)))
    theta = np.concatenate([np.zeros(len(used)), first[:1], gap])
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        weights, cuts = theta[: len(used)], _thresholds(theta[len(used) :])
        score = SCALE * np.bincount(row, weights=weights[column], minlength=len(kept))
        tail = 1 / (1 + np.exp(-(score[:, None] - cuts[None, :])))
        padded = np.hstack([np.ones((len(kept), 1)), tail, np.zeros((len(kept), 1))])
        chosen = np.arange(len(kept))
        likelihood = np.maximum(padded[chosen, grades] - padded[chosen, grades + 1], 1e-9)
        slope = np.zeros_like(padded)
        slope[:, 1:-1] = tail * (1 - tail)
        low, high = slope[chosen, grades], slope[chosen, grades + 1]
        by_score = -(low - high) / likelihood / len(kept)
        by_cut = np.zeros(steps)
        np.add.at(by_cut, np.maximum(grades - 1, 0), np.where(grades > 0, low / likelihood, 0) / len(kept))
        np.add.at(by_cut, np.minimum(grades, steps - 1), np.where(grades < steps, -high / likelihood, 0) / len(kept))
        by_weight = SCALE * np.bincount(column, weights=by_score[row], minlength=len(used)) + RIDGE * weights
        by_gap = [by_cut[k + 1 :].sum() / (1 + np.exp(-theta[len(used) + 1 + k])) for k in range(steps - 1)]
        gradient = np.concatenate([by_weight, [by_cut.sum()], by_gap])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIMENSIONS)
    weights[used] = theta[: len(used)]
    return OrdinalModel(weights, _thresholds(theta[len(used) :]))


def _thresholds(theta: np.ndarray) -> np.ndarray:
    return np.concatenate([theta[:1], theta[0] + np.cumsum(np.log1p(np.exp(theta[1:])))])


def sample_features(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of at most ``sample`` labelled documents."""
    rated = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.min(F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2)).alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id").select("doc_id", "grade", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [row.tobytes() for row in text_features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array(packed, pa.binary())],
                names=["doc_id", "grade", "features"],
            )

    found = in_arrow(rows, featured, "doc_id bigint, grade int, features binary")
    # of rows of one id the least by its features, so that no more than the sample is gathered
    each = found.groupBy("doc_id").agg(F.min(F.struct("grade", "features")).alias("least")).select("doc_id", "least.*")
    gathered = each.toArrow().sort_by("doc_id")
    features = [np.frombuffer(row, dtype=np.int32) for row in gathered["features"].to_pylist()]
    return features, np.array(gathered["grade"].to_pylist(), dtype=np.int64)


def score_quality(docs: DataFrame, model: OrdinalModel, *, text: str = "text") -> DataFrame:
    """``docs`` as a struct ``doc`` with score, expected_grade and p_top."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each of DIMENSIONS places
    schema = docs.select(F.struct("*").alias("doc")).schema
    at = docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = broadcast.value
        for batch in batches:
            scores = fitted.score(pc.struct_field(batch.column(0), [at]))
            tails = fitted.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(tails.sum(1)), pa.array(tails[:, -1])],
                names=["doc", "score", "expected_grade", "p_top"],
            )

    rows = docs.select(F.struct("*").alias("doc"))  # with the text, which is sent once
    doc = schema["doc"].dataType.simpleString()
    return in_arrow(rows, scored, f"doc {doc}, {SCORES}")


def selected() -> Column:
    """Whether a scored document is kept."""
    return (F.col("p_top") >= KEEP) | (F.col("score") >= 0)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> OrdinalModel:
    return fit(*sample_features(docs, table(spark, sf_dir, "labels")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(spark, docs, sf_dir)
    return score_quality(docs, model).select(
        "doc.doc_id", "score", "expected_grade", "p_top", selected().alias("keep")
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are probably of the top grade."""
    small_batches(spark)
    model = quality_model(spark, docs, sf_dir)
    return score_quality(docs, model).where(selected()).select("doc.*")
