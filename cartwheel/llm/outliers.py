"""Quality rules with robust multivariate outliers.

Documents that break a fixed rule (too few words, too much repetition) go. The others are described by a vector of
transformed statistics, and those far from the bulk of their language and source go as well. The bulk is found by
the minimum covariance determinant: of all subsets with ``SUBSET`` of the rows, the one whose covariance has the
least determinant. Rows outside of it, and so whatever junk a source holds, do not move the estimate.

The estimate is made of sums over all rows, for all groups at once:

1. Medians and median deviations of each statistic, from counts of its values.
2. Three starts: the deviations alone, and with them the correlations of squashed values and of spatial signs.
3. Concentration: every row's distance under each start is put in a narrow bin; rows are summed per bin, and the lowest bins
   that hold ``SUBSET`` of the rows give the next estimate, whose determinant is no larger. This is repeated until
   no estimate shrinks, at most ``STEPS`` times, and the start with the least determinant is taken.
4. One reweighted step over the rows within the ``INLIER`` quantile gives the final center and covariance.

A row's squared Mahalanobis distance is then compared with the ``REJECT`` quantile of a chi-squared
distribution. ``FLOORS`` are added to the covariance, so that a statistic which is the same in nearly all
documents rejects no small departure.

Statistics are whole multiples of 1 / ``UNIT`` and all sums are sums of integers, so the result does not depend on how rows
are spread. Rows are summed per task and bin before they are shuffled, which makes a group with a large share of
the rows no slower; a group reaches one task as at most ``BINS`` sums. Sources with fewer than ``GROUP``
rows are pooled within their language, languages whose pool is still smaller with each other; a last pool smaller than that is not judged.

Defined results: null text counts as empty and breaks the rules; null languages and sources are values of their own;
each row counts, repeated ones as well, and equal rows get equal verdicts. Other columns are not carried. The text of a document
is worked on in one piece, which takes memory in proportion to the longest one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import words
from cartwheel.llm.tables import in_arrow, saved, ship, table

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
RUN = 3  # words of a repeated run

SUBSET = 0.75
STEPS = 12
INLIER, REJECT = 0.975, 0.999999
UNIT = 256
BINS, BINS_PER_DOUBLING = 1024, 32
GROUP = 100  # rows that an estimate needs
SQUASHED = 4096

STATISTICS = ("length", "word_length", "symbols", "repeats", "lines", "others")
# Standard deviations that are added to each statistic's own.
FLOORS = (0.25, 0.05, 0.05, 0.15, 0.20, 0.06)
SIZE = len(STATISTICS)
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters")


def _equal_keys(hashed: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by row and value, and which in that order equal the one before."""
    keys = words.mix(hashed + words.mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.concatenate([[False], ordered[1:] == ordered[:-1]]) if len(keys) else np.zeros(0, bool)


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The counts of each text, one column each."""
    rows = len(offsets) - 1
    starts, stops, before = words.spans(data, offsets, words.separators(words.BLANKS))
    row = np.repeat(np.arange(rows), np.diff(before))

    # Lines that hold a word: the last line begin up to each word's place.
    begins = np.union1d(np.flatnonzero(data == 0x0A) + 1, offsets[:-1])
    line = np.unique(np.searchsorted(begins, starts, side="right") - 1)
    ends = np.append(begins[1:], len(data))[line]
    ends -= (ends > begins[line]) & (data[np.maximum(ends - 1, 0)] == 0x0A) if len(line) else 0
    line_row = np.searchsorted(offsets, begins[line], side="right") - 1
    order, again = _equal_keys(words.hashes(data, begins[line], ends, fold=False), line_row)
    repeated_lines = np.bincount(line_row[order[again]], minlength=rows)

    hashed = words.hashes(data, starts, stops, fold=False)
    runs = words.chained(hashed, RUN)
    whole = np.flatnonzero(row[: len(runs)] == row[RUN - 1 :]) if len(runs) else np.zeros(0, np.int64)
    order, again = _equal_keys(runs[whole], row[whole])
    again[:-1] |= again[1:]
    covered = np.zeros(len(row), dtype=bool)
    for step in range(RUN):
        covered[whole[order[again]] + step] = True

    symbol = words.separators(SYMBOLS)[data]
    letter = ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z")) & (data < 0x80) | (data >= 0xC0)
    shown = ~words.separators(words.BLANKS)[data] & ((data & 0xC0) != 0x80)

    def of_text(mask: np.ndarray) -> list[int]:
        return [int(np.count_nonzero(mask[begin:end])) for begin, end in zip(offsets[:-1], offsets[1:])]

    return np.column_stack(
        [
            np.diff(before), of_text(shown), of_text(symbol), repeated_lines,
            np.bincount(row[covered], minlength=rows), np.bincount(line_row, minlength=rows), of_text(letter),
        ]
    ).astype(np.int64)


def statistics(counts: np.ndarray) -> np.ndarray:
    """The transformed statistics of each text, in units of 1 / ``UNIT``."""
    n_words, chars, symbols, lines_again, repeats, lines, letters = np.maximum(counts, 0).T.astype(np.float64)
    some, some_chars = np.maximum(n_words, 1), np.maximum(chars, 1)
    values = [
        np.log(some),
        np.log(some_chars / some),
        np.sqrt(symbols / some_chars),
        np.sqrt(repeats / some),
        np.sqrt(lines_again / np.maximum(lines, 1)),
        np.sqrt(np.maximum(chars - letters, 0) / some_chars),
    ]
    return np.rint(np.column_stack(values) * UNIT).astype(np.int64)


def text_counts(column: pa.Array) -> Iterator[np.ndarray]:
    for begin, end in words.slices(column):
        yield _counts(*words.text_bytes(column.slice(begin, end - begin)))


def text_statistics(docs: DataFrame, *, text: str = "text", keys: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The counts of each text and, as ``x0`` to ``x5``, its transformed statistics, beside the key columns."""
    read = docs.select(*(F.col(name) for name in keys), F.col(text).alias("_text"))
    own = [T.StructField(name, T.LongType()) for name in (*COUNTS, *(f"x{at}" for at in range(SIZE)))]
    schema = T.StructType([*read.drop("_text").schema.fields, *own])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [*text_counts(batch.column("_text")), np.zeros((0, len(COUNTS)), np.int64)]
            counts = np.concatenate(parts)
            found = np.column_stack([counts, statistics(counts)])
            columns = [batch.column(name) for name in keys] + [pa.array(column) for column in found.T]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return in_arrow(read, measured, schema)


def broken_rules() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _labelled(rows: DataFrame) -> DataFrame:
    """``rows`` with the group that judges them; NULL for those that break a rule, and where all pools are too small."""
    lang, source, passed = F.col("lang").cast("string"), F.col("source").cast("string"), ~F.col("base_failed")
    sizes = saved(
        rows.where(passed).groupBy(F.to_json(F.array(lang)).alias("_lang"), F.to_json(F.array(lang, source)).alias("_source")).agg(F.count("*").alias("_n")),
        "source-sizes",
    )
    pools = saved(sizes.where(F.col("_n") < GROUP).groupBy("_lang").agg(F.sum("_n").alias("_pooled")), "language-pools")
    (rest,) = pools.where(F.col("_pooled") < GROUP).agg(F.coalesce(F.sum("_pooled"), F.lit(0))).first()
    label = (
        F.when(F.col("_n") >= GROUP, F.concat(F.lit("source "), "_source"))
        .when(F.col("_pooled") >= GROUP, F.concat(F.lit("language "), "_lang"))
        .when(F.lit(rest >= GROUP), F.lit("others"))
    )
    labels = saved(sizes.join(pools, "_lang", "left").select("_source", label.alias("label")), "labels")
    keyed = rows.withColumn("_source", F.when(passed, F.to_json(F.array(lang, source))))
    return keyed.join(labels, "_source", "left").drop("_source")


def _sums(columns: list[Column], name: str) -> list[Column]:
    """The sums of the columns and of their products."""
    first = [F.sum(column).alias(f"{name}_{i}") for i, column in enumerate(columns)]
    return first + [F.sum(columns[i] * columns[j]).alias(f"{name}_{i}_{j}") for i, j in PAIRS]


def _x() -> list[Column]:
    return [F.col(f"x{at}") for at in range(SIZE)]


def _distance() -> Column:
    """The squared distance of a row from ``center``, by the rows of ``factor``, the inverse of the covariance's root."""
    off = [x - F.col("center")[at] for at, x in enumerate(_x())]
    place = {pair: at for at, pair in enumerate(PAIRS)}
    parts = [reduce(Column.__add__, [F.col("factor")[place[i, j]] * off[j] for j in range(i + 1)]) for i in range(SIZE)]
    return reduce(Column.__add__, [part * part for part in parts])


def chi_squared(value: float, freedom: int) -> float:
    """The chi-squared distribution function, by the series of the incomplete gamma function."""
    half, shape = value / 2, freedom / 2
    if half <= 0:
        return 0.0
    term = math.exp(shape * math.log(half) - half - math.lgamma(shape + 1))
    total, at = 0.0, shape
    while term > 1e-18 * max(total, 1e-300):
        total, at = total + term, at + 1
        term *= half / at
    return min(total, 1.0)


def quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(middle, freedom) < share else (low, middle)
    return high


def _consistency(share: float) -> float:
    """What the covariance of the innermost ``share`` of a normal distribution has to be multiplied by."""
    return share / chi_squared(quantile(share, SIZE), SIZE + 2)


def _factor(covariance: np.ndarray) -> tuple[list[float], float]:
    """The inverse of the covariance's root, row by row, and the logarithm of the determinant, with the floors added."""
    root = np.linalg.cholesky(covariance + np.diag((np.array(FLOORS) * UNIT) ** 2))
    inverse = np.linalg.inv(root)
    return [float(inverse[i, j]) for i, j in PAIRS], float(2 * np.log(np.diag(root)).sum())


def _moments(sums: pd.Series, n: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    mean = np.array([sums[f"{name}_{i}"] for i in range(SIZE)], dtype=np.float64) / n
    covariance = np.zeros((SIZE, SIZE))
    for i, j in PAIRS:
        covariance[i, j] = covariance[j, i] = sums[f"{name}_{i}_{j}"] / n - mean[i] * mean[j]
    return mean, covariance


def _correlation(covariance: np.ndarray) -> np.ndarray:
    """A correlation matrix, drawn a little to the diagonal so that it has an inverse."""
    scale = np.sqrt(np.maximum(np.diag(covariance), 1.0))
    return 0.95 * covariance / np.outer(scale, scale) + 0.05 * np.eye(SIZE)


def _middle(values: np.ndarray, counts: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(counts[order])
    return float(values[order][np.searchsorted(2 * reached, reached[-1])])


def location(values: pd.DataFrame) -> pd.DataFrame:
    """Median and spread of each statistic of a group, from its values and how often they occur."""
    center, spread = [], []
    for at in range(SIZE):
        own = values[values.statistic == at]
        value, n = own.value.to_numpy(), own.n.to_numpy()
        middle = _middle(value, n)
        center.append(middle)
        spread.append(math.hypot(1.4826 * _middle(np.abs(value - middle), n), FLOORS[at] * UNIT))
    return pd.DataFrame({"label": [values.label.iloc[0]], "center": [center], "spread": [spread]})


def starts(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Three estimates of each group, from its spreads and two kinds of correlations."""
    for frame in groups:
        rows = []
        for _, sums in frame.iterrows():
            scale = np.diag(np.array(sums["spread"]))
            shapes = [np.eye(SIZE)]
            shapes += [_correlation(_moments(sums, sums["n"], name)[1]) for name in ("squashed", "sign")]
            for number, shape in enumerate(shapes):
                factor, _ = _factor(scale @ shape @ scale)
                rows.append((sums["label"], number, list(sums["center"]), factor, math.inf, True))
        yield pd.DataFrame(rows, columns=["label", "start", "center", "factor", "size", "shrinks"])


ESTIMATE = "label string, start int, center array<double>, factor array<double>, size double, shrinks boolean"


def concentrated(bins: pd.DataFrame) -> pd.DataFrame:
    """The next estimate of a group and start, from the lowest bins of distance that hold the subset."""
    bins = bins.sort_values("bin")
    reached = np.cumsum(bins["n"].to_numpy())
    inner = bins.iloc[: int(np.searchsorted(reached, math.ceil(SUBSET * reached[-1]))) + 1]
    n = int(inner["n"].sum())
    mean, covariance = _moments(inner.drop(columns=["label"]).sum(), n, "x")
    factor, size = _factor(covariance * _consistency(n / reached[-1]) if n < reached[-1] else covariance)
    before = float(bins["size"].iloc[0])
    row = (bins["label"].iloc[0], int(bins["start"].iloc[0]), list(mean), factor, size, size < before - 1e-6)
    return pd.DataFrame([row], columns=["label", "start", "center", "factor", "size", "shrinks"])


def reweighted(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in groups:
        rows = []
        for _, sums in frame.iterrows():
            mean, covariance = _moments(sums, sums["n"], "x")
            rows.append((sums["label"], list(mean), _factor(covariance * _consistency(INLIER))[0]))
        yield pd.DataFrame(rows, columns=["label", "center", "factor"])


def estimates(rows: DataFrame) -> DataFrame:
    """Center and factor of the covariance for every label of ``rows``, which hold ``label`` and ``x0`` to ``x5``."""
    spark = rows.sparkSession
    ship(spark)
    rows = rows.where("label IS NOT NULL").select("label", *_x())
    listed = F.array(*(F.struct(F.lit(at).alias("statistic"), x.alias("value")) for at, x in enumerate(_x())))
    values = rows.select("label", F.inline(listed)).groupBy("label", "statistic", "value").agg(F.count("*").alias("n"))
    places = saved(
        values.groupBy("label").applyInPandas(location, "label string, center array<double>, spread array<double>"), "medians"
    )

    scaled = [(x - F.col("center")[at]) / F.col("spread")[at] for at, x in enumerate(_x())]
    norm = F.sqrt(reduce(Column.__add__, [z * z for z in scaled]))
    squashed = [F.round(F.tanh(z) * SQUASHED).cast("bigint") for z in scaled]
    signs = [F.when(norm > 0, F.round(z / norm * SQUASHED)).otherwise(F.lit(0.0)).cast("bigint") for z in scaled]
    named = [column.alias(f"{kind}{at}") for kind, columns in (("t", squashed), ("s", signs)) for at, column in enumerate(columns)]
    sums = [F.count("*").alias("n")]
    for kind, name in (("t", "squashed"), ("s", "sign")):
        sums += _sums([F.col(f"{kind}{at}") for at in range(SIZE)], name)
    moments = rows.join(places, "label").select("label", *named).groupBy("label").agg(*sums)
    current = saved(moments.join(places, "label").mapInPandas(starts, ESTIMATE), "starts")

    bin_of = F.least(F.floor(F.log2(1 + _distance()) * BINS_PER_DOUBLING), F.lit(BINS - 1)).cast("int")
    for _ in range(STEPS):
        summed = (
            rows.join(current, "label")
            .select("label", "start", "size", *_x(), bin_of.alias("bin"))
            .groupBy("label", "start", "bin")
            .agg(F.count("*").alias("n"), F.max("size").alias("size"), *_sums(_x(), "x"))
        )
        current = saved(summed.groupBy("label", "start").applyInPandas(concentrated, ESTIMATE), "estimates")
        if current.where("shrinks").isEmpty():
            break
    best = saved(
        current.groupBy("label")
        .agg(F.min_by(F.struct("center", "factor"), F.struct("size", "start")).alias("best"))
        .select("label", "best.*"),
        "best-estimates",
    )
    inner = rows.join(best, "label").where(_distance() <= quantile(INLIER, SIZE)).select("label", *_x())
    weighed = inner.groupBy("label").agg(F.count("*").alias("n"), *_sums(_x(), "x"))
    return saved(weighed.mapInPandas(reweighted, "label string, center array<double>, factor array<double>"), "final-estimates")


def judged(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """One row per document: its counts, whether it breaks a rule, its group, its squared distance and whether it is kept."""
    measured = saved(text_statistics(docs, text=text).withColumn("base_failed", broken_rules()), "statistics")
    rows = saved(_labelled(measured), "labelled")
    distant = rows.join(estimates(rows), "label", "left").withColumn("distance", F.when(F.col("center").isNotNull(), _distance()))
    near = F.coalesce(F.col("distance") <= quantile(REJECT, SIZE), F.lit(True))
    return distant.withColumn("kept", ~F.col("base_failed") & near).drop("center", "factor", *(f"x{at}" for at in range(SIZE)))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", *COUNTS[:5], "base_failed", "kept", F.col("label").alias("judged_by"), "distance"
    )
