"""The similarity join against all pairs."""

import random
import re

import numpy as np
import pytest

from cartwheel.llm import ngram_join as N
from cartwheel.llm import words
from cartwheel.llm.components import components
from cartwheel.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    found = WORD.findall((text or "").translate(FOLD))
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)} if len(found) >= 5 else ({tuple(found)} if found else set())


def brute(rows):
    """(doc_id, n_shingles, component_id) of each row, sorted."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                parent[find(a)] = find(b)
    ids = {}
    for at, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(at), []).append(doc_id)
    names = {root: min((i for i in own if i is not None), default=None) for root, own in ids.items()}
    return sorted(map(repr, ((i, len(sets[at]), names[find(at)]) for at, (i, _) in enumerate(rows))))


def found(df):
    return sorted(map(repr, map(tuple, df.select("doc_id", "n_shingles", "component_id").collect())))


def test_query_against_all_pairs(spark, sf_dir):
    import pyarrow.parquet as pq

    rows = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    assert found(QUERIES["op3_ngram_join"](spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_near_copies(spark, seed):
    """Copies of copies with ever more changes, at all similarities around the threshold, with shared passages."""
    draw = random.Random(seed)
    passage = [f"p{k}" for k in range(25)]
    rows = []
    for family in range(8):
        text = [f"f{family}w{k}" for k in range(draw.choice([3, 6, 30, 80]))]
        for _ in range(14):
            for _ in range(draw.choice([0, 1, 1, 2])):
                text[draw.randrange(len(text))] = f"x{draw.randrange(5)}"
            body = [*passage, *text] if draw.random() < 0.4 else list(text)
            rows.append((len(rows), " ".join(body).replace("w", draw.choice("wW"))))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(N.SimilarDocuments(df).components()) == brute(rows)


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    similar = N.SimilarDocuments(odd_docs)
    expected = brute(rows)
    assert found(similar.components()) == expected
    one = similar.one_each()
    assert one.columns == odd_docs.columns
    assert one.count() == similar.rows().select("root").distinct().count()
    none = N.SimilarDocuments(no_docs)
    assert none.components().collect() == [] and none.one_each().collect() == []


def test_large_group_of_near_copies_makes_few_pairs(spark):
    base = [f"b{k}" for k in range(60)]
    rows = []
    for at in range(600):
        text = list(base)
        text[at % 60] = f"own{at}"
        rows.append((at, " ".join(text)))
    similar = N.SimilarDocuments(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.component_id for r in similar.components().collect()} == {0}
    assert similar.links.count() == 599


def test_prefixes_of_linked_sets_meet_under_any_order():
    draw = np.random.default_rng(1)
    for _ in range(300):
        size = int(draw.integers(1, 60))
        universe = draw.integers(0, 2**63, size + 30).astype(np.uint64)
        left = np.unique(universe[:size])
        right = np.unique(universe[int(draw.integers(0, 6)) : size + int(draw.integers(0, 6))])
        if len(left) and len(right) and N.linked(left, right):
            for key in (0, *N.ORDERS):
                assert np.intersect1d(N.order_prefix(left, key), N.order_prefix(right, key)).size


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (300, 200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.a: r.b for r in components(df).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 50)} | {300: 200}
    assert components(df.where("false")).collect() == []


def test_shingles_are_counted_like_words(spark):
    import pyarrow as pa

    texts = ["a b c d e f", "A\tB\nC D E F", "a", "", None, " \x0b ", "é x y z w v", "a b c d e a b c d e a"]
    sets = list(words.shingle_sets(pa.array(texts), 5))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all()
