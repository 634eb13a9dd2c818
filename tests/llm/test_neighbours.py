"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from cartwheel.llm.neighbours import MultiIndex, fit, neighbours
from cartwheel.llm.queries import QUERIES


def brute(ids, vectors, every, top):
    out = {}
    for at, query in enumerate(ids):
        if query % every == 0:
            scores = (vectors * vectors[at]).sum(1)
            order = sorted((k for k in range(len(ids)) if ids[k] != query), key=lambda k: (-scores[k], ids[k]))[:top]
            out[query] = [(ids[k], scores[k]) for k in order]
    return out


def found(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert row["rank"] == len(out.setdefault(row.query_id, [])) + 1
        out[row.query_id].append((row.vec_id, row.score))
    return out


def recall(expected, got):
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in got.get(q, [])}) for q in expected)
    return hits / sum(len(best) for best in expected.values())


def test_query_reaches_the_wanted_recall(spark, sf_dir):
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{sf_dir}/embeddings.parquet")
    ids, vectors = rows["vec_id"].to_numpy(), np.array(rows["embedding"].to_pylist(), dtype=np.float64)
    got = found(QUERIES["op2_neighbours"](spark, sf_dir))
    expected = brute(ids, vectors, 20, 20)
    assert got.keys() == expected.keys()
    assert recall(expected, got) >= 0.9
    for query, best in got.items():
        assert len(best) == 20
        assert best == sorted(best, key=lambda pair: (-pair[1], pair[0]))
        for vec_id, score in best:
            assert score == pytest.approx(float(vectors[ids == vec_id][0] @ vectors[ids == query][0]), abs=1e-12)


def test_clusters_need_a_small_share():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 16))
    points = np.repeat(centres, 50, axis=0) + 0.02 * draw.normal(size=(2000, 16))
    assert fit(points[draw.permutation(2000)], 2000, 10).share <= 0.25


def test_walk_visits_pairs_of_centroids_in_falling_order():
    draw = np.random.default_rng(5)
    halves = draw.normal(size=(6, 3)), draw.normal(size=(6, 3))
    counts = draw.integers(0, 4, 36)
    query = draw.normal(size=(1, 6))
    index = MultiIndex(halves, 1.0)
    left, right = index.half_scores(query)
    sums = (left[0][:, None] + right[0][None, :]).ravel()
    walked = index.walk(left[0], right[0], counts, int(counts.sum()))
    assert walked == [cell for cell in np.argsort(-sums, kind="stable") if counts[cell]]
    part = index.walk(left[0], right[0], counts, 7)
    assert part == walked[: len(part)] and counts[part].sum() >= 7 > counts[part[:-1]].sum()


def test_odd_vectors(spark):
    same = [0.5, 0.5]
    rows = [(at, same) for at in range(0, 60)] + [
        (100, None),
        (101, [0.0, 0.0]),
        (102, [None, 1.0]),
        (103, [float("nan"), 1.0]),
        (104, [float("inf"), 1.0]),
        (105, [1.0]),
        (None, [1.0, 1.0]),
        (110, [3.0, 4.0]),
        (110, [3.0, 4.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = found(neighbours(df, every=20, top=20))
    assert got.keys() == {0, 20, 40}
    for query, best in got.items():
        # ties are ranked by id, the query itself is left out
        assert [i for i, _ in best] == [110, *[i for i in range(21) if i != query][:19]]
    assert neighbours(df.where("false"), every=20, top=20).collect() == []
    few = found(neighbours(df.where("vec_id in (0, 110)"), every=20, top=20))
    assert few == {0: [(110, 3.5)]}
