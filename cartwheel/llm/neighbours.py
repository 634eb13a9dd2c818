"""Nearest neighbours by inner product, through an inverted multi-index.

The two halves of the vectors are quantised separately, by k-means with ``K`` centroids each, so that K * K
cells index every vector. A query scores the centroids of each half and walks the pairs of centroids in
falling order of summed score, with a heap over the two sorted lists, until the cells it has visited hold enough
entries. Those entries are reranked by the inner product of the original vectors in double precision.

How many entries are enough is measured, not guessed: on the sample the k-means is fitted on, the share of
entries is found that reaches the wanted recall against brute force. Vectors without any cluster need a large
share; the walk then costs what brute force over that share costs.

The centroids and that share come from at most ``SAMPLE`` vectors, the first by a hash of their id, which
the driver gathers; cell sizes, K * K numbers at most, are counted over all. Entries are dealt to shards of
consecutive cells of about ``SHARD`` entries, a larger cell to several shards by a hash of the id, and
queries to blocks of about ``BLOCK``, so every group is bounded. A group hands on at most ``top`` entries
for each query.

Defined results: vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, and neither do rows without an id. Of rows with equal ids the smallest vector takes
part. Equal scores are ranked by id. With fewer other vectors than ``top`` all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.tables import in_arrow, saved, ship, table

SAMPLE = 20_000
MOST_CENTROIDS = 256
PER_CELL = 50  # vectors, which sets the number of centroids
ROUNDS = 12  # of k-means
TEST_QUERIES = 400
RECALL = 0.97  # wanted on the sample
SHARD = 8192
BLOCK = 4096
TOGETHER = 64  # queries multiplied at once
NEAR = 1e-9  # scores this close to the last place are summed again, in one order for all


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves, entries in each cell, and the shards that hold it."""

    halves: tuple[np.ndarray, np.ndarray]
    share: float
    counts: np.ndarray | None = None
    first_shard: np.ndarray | None = None
    shards: np.ndarray | None = None

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        middle = self.halves[0].shape[1]
        left, right = (nearest(part, half) for part, half in zip((vectors[:, :middle], vectors[:, middle:]), self.halves))
        return left * len(self.halves[1]) + right

    def half_scores(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = self.halves[0].shape[1]
        return vectors[:, :middle] @ self.halves[0].T, vectors[:, middle:] @ self.halves[1].T

    def walk(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
        """Cells with entries in falling order of summed score, until they hold ``wanted``."""
        order = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        left, right = (-left[order[0]]).tolist(), (-right[order[1]]).tolist()
        rows, columns, width = order[0].tolist(), order[1].tolist(), len(right)
        heap, visited, held = [(left[0] + right[0], 0, 0)], [], 0
        while heap and held < wanted:
            _, row, column = heapq.heappop(heap)
            # each pair is reached once: along its row, and at the first column from the row above
            if column + 1 < width:
                heapq.heappush(heap, (left[row] + right[column + 1], row, column + 1))
            if column == 0 and row + 1 < len(left):
                heapq.heappush(heap, (left[row + 1] + right[0], row + 1, 0))
            cell = rows[row] * width + columns[column]
            if counts[cell]:
                visited.append(cell)
                held += int(counts[cell])
        return visited


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centroids.T - 0.5 * (centroids * centroids).sum(1), axis=1)


def centroids(points: np.ndarray, count: int) -> np.ndarray:
    """k-means; it starts from points spread evenly over the sample, so it holds no randomness."""
    chosen = points[np.linspace(0, len(points) - 1, count).astype(int)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, chosen)
        sums = np.zeros_like(chosen)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=count)
        chosen[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return chosen


def fit(sample: np.ndarray, total: int, top: int) -> MultiIndex:
    """An index fitted on the sample, with the share of entries that reaches the wanted recall on it."""
    count = int(np.clip(np.sqrt(total / PER_CELL), 8, MOST_CENTROIDS))
    count = min(count, len(sample))
    middle = max(1, sample.shape[1] // 2)
    index = MultiIndex((centroids(sample[:, :middle], count), centroids(sample[:, middle:], count)), 1.0)
    queries = np.linspace(0, len(sample) - 1, min(TEST_QUERIES, len(sample))).astype(int)
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=count * len(index.halves[1]))
    needed = []
    left, right = index.half_scores(sample[queries])
    for at, query in enumerate(queries):
        scores = sample @ sample[query]
        scores[query] = -np.inf
        best = np.argpartition(-scores, min(top, len(scores) - 1))[:top]
        order = np.argsort(-(left[at][:, None] + right[at][None, :]).ravel(), kind="stable")
        reached = np.empty(len(order))
        reached[order] = np.cumsum(counts[order])
        needed.append(reached[cells[best[best != query]]] / len(sample))
    share = float(np.quantile(np.concatenate(needed), RECALL)) if len(sample) > 1 else 1.0
    return MultiIndex(index.halves, share)


def usable(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    value = F.col("vector")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & value.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = rows.where(F.exists(value, lambda x: x != 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1)
    size = sizes.first()
    return rows.where(F.size("vector") == (size["size"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = len(column[0]) if len(column) else 1
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _salt(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever its vector lies."""
    return (vectors * query).sum(axis=1)


def _best(rough: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the best entries by ``rough`` scores, equal scores by id."""
    if len(rough) > top:
        bound = -np.partition(-rough, top - 1)[top - 1]
        near = np.flatnonzero((rough >= bound - NEAR * max(1.0, abs(bound))) & (rough > -np.inf))
    else:
        near = np.flatnonzero(rough > -np.inf)
    scores = _exact(vectors[near], query)
    order = np.lexsort((ids[near], -scores))[:top]
    return scores[order], ids[near][order]


def neighbours(vectors: DataFrame, *, every: int, top: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the best entries for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = saved(usable(vectors, id=id, vector=vector), "vectors")
    total = rows.count()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], empty)
    gathered = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    index = fit(_matrix(gathered["vector"]), total, top)
    width = len(index.halves[0]) * len(index.halves[1])

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = index.cells(_matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(cells, pa.int64())], names=["vec_id", "vector", "cell"])

    entries = saved(in_arrow(rows, celled, "vec_id bigint, vector array<double>, cell bigint"), "cells")
    counts = np.zeros(width, dtype=np.int64)
    for cell, held in entries.groupBy("cell").count().collect():  # one row for each of at most K * K cells
        counts[cell] = held
    shards = np.maximum(1, -(-counts // SHARD))
    # consecutive small cells share a shard, a large cell has shards of its own
    first = np.zeros(width, dtype=np.int64)
    number, filled = 0, 0
    for cell in range(width):
        if shards[cell] > 1 or filled + counts[cell] > SHARD:
            number, filled = number + (filled > 0), 0
        first[cell] = number
        if shards[cell] > 1:
            number += int(shards[cell])
        else:
            filled += int(counts[cell])
    index = MultiIndex(index.halves, index.share, counts, first, shards)
    known = spark.sparkContext.broadcast(index)  # at most K * K cells of three numbers, and 2 K half vectors
    n_queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).count()
    blocks = -(-max(n_queries, 1) // BLOCK)
    wanted = int(np.ceil(index.share * total)) + 1

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = known.value
        for batch in batches:
            ids, cells = batch.column("vec_id").to_numpy(), batch.column("cell").to_numpy()
            shard = at.first_shard[cells] + (_salt(ids) % at.shards[cells].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=["vec_id", "vector", "cell", "shard"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = known.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                left, right = at.half_scores(_matrix(part.column("vector")))
                query, shard, cells = [], [], []
                for row in range(part.num_rows):
                    visits: dict[int, list[int]] = {}
                    for cell in at.walk(left[row], right[row], at.counts, wanted):
                        begin_shard = int(at.first_shard[cell])
                        for salted in range(begin_shard, begin_shard + int(at.shards[cell])):
                            visits.setdefault(salted, []).append(cell)
                    query += [row] * len(visits)
                    shard += visits.keys()
                    cells += visits.values()
                chosen = part.take(pa.array(query, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [chosen.column("vec_id"), chosen.column("vector"), pa.array(shard, pa.int64()), pa.array(cells, pa.list_(pa.int32()))],
                    names=["vec_id", "vector", "shard", "cells"],
                )

    def reranked(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            entry_cells, ids = right["cell"].to_numpy(), right["vec_id"].to_numpy()
            entries_, queries = _matrix(right["vector"]), _matrix(left["vector"])
            query_ids, cells = left["vec_id"].to_numpy(), left["cells"]
            lowest = int(entry_cells.min())
            place = entry_cells - lowest
            for begin in range(0, len(queries), TOGETHER):
                rough = queries[begin : begin + TOGETHER] @ entries_.T
                for row, scores in enumerate(rough, begin):
                    visited = np.zeros(int(place.max()) + 1, dtype=bool)
                    visited[np.array(cells[row].as_py()) - lowest] = True
                    scores[~visited[place] | (ids == query_ids[row])] = -np.inf
                    best, found = _best(scores, entries_, ids, queries[row], top)
                    out.append((np.full(len(found), query_ids[row]), found, best))
        columns = [np.concatenate([part[k] for part in out]) if out else np.zeros(0) for k in range(3)]
        return pa.table(
            {
                "query_id": pa.array(columns[0].astype(np.int64)),
                "vec_id": pa.array(columns[1].astype(np.int64)),
                "score": pa.array(columns[2].astype(np.float64)),
            }
        )

    ship(spark)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    queries = in_arrow(
        rows.where(F.pmod("vec_id", F.lit(every)) == 0), walked, "vec_id bigint, vector array<double>, shard bigint, cells array<int>"
    ).withColumn("block", block)
    dealt = in_arrow(entries, sharded, "vec_id bigint, vector array<double>, cell bigint, shard bigint")
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    found = (
        queries.groupBy("shard", "block")
        .cogroup(dealt.groupBy("shard", "block"))
        .applyInArrow(reranked, "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), every=20, top=20)
