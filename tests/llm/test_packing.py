"""Packing: pieces cover every document once, sequences have no gap, little padding, balanced steps."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import packing as P
from cartwheel.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def padded(length):
    return length if length & (length - 1) == 0 else P.WINDOW


def check(pieces):
    """Sequences and documents of (doc, start, length, sequence, offset, total) add up."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset, total in pieces:
        assert length > 0
        sequences[sequence].append((offset, length))
        docs[doc].append((start, length, total))
    for rows in sequences.values():
        rows.sort()
        end = 0
        for offset, length in rows:
            assert offset == end
            end += length
        assert end <= P.WINDOW
    for rows in docs.values():
        rows.sort()
        end = 0
        for start, length, total in rows:
            assert start == end
            end += length
        assert end == rows[0][2]
    tokens = sum(length for rows in sequences.values() for _, length in rows)
    room = sum(padded(sum(length for _, length in rows)) for rows in sequences.values())
    return tokens, room


def test_query_against_the_tokenizer(spark, sf_dir, tokenizer):
    import pyarrow.parquet as pq

    texts = dict(zip(*(pq.read_table(f"{sf_dir}/documents.parquet")[name].to_pylist() for name in ("doc_id", "text"))))
    rows = QUERIES["op7_packing"](spark, sf_dir).collect()
    tokens, room = check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset, r.doc_tokens) for r in rows])
    assert room <= 1.01 * tokens
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        ids = tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids + [1]
        assert len(ids) == row.doc_tokens
        assert zlib.crc32(np.array(ids[row.start : row.start + row.length], dtype="<u4").tobytes()) == row.ids_crc32


def test_ids_are_those_of_the_tokenizer(tokenizer):
    draw = random.Random(5)
    parts = [" ", "\n", "a", "é", "1", ".", "'s", "漢", "😀", "\u0085", "\r\n", "<|endoftext|>", "　", "\x00", "ΐ", "  "]
    encoder = P.encoder(public_tokenizers.path(P.TOKENIZER))
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(40)))
        assert encoder.encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_pack_any_lengths(seed):
    draw = random.Random(seed)
    most = draw.choice([5, 300, 1100, 2048, 9000])
    lengths = [draw.randrange(1, most + 1) for _ in range(draw.randrange(1, 400))]
    sequences = P.pack(lengths)
    pieces = [
        (piece.doc, piece.start, piece.length, number, sum(p.length for p in own[:at]), lengths[piece.doc])
        for number, (_, own) in enumerate(sequences)
        for at, piece in enumerate(own)
    ]
    tokens, room = check(pieces)
    assert tokens == sum(lengths) == room
    assert all(sum(p.length for p in own) == tier for tier, own in sequences)


def test_gaps_are_filled_from_shorter_tiers_before_anything_is_cut():
    sequences = P.pack([1500, 500, 48, 1000, 24, 1000, 10, 14])
    assert [(tier, sorted((p.doc, p.length) for p in own)) for tier, own in sequences[:3]] == [
        (2048, [(0, 1500), (1, 500), (2, 48)]),
        (1024, [(3, 1000), (4, 24)]),
        (1024, [(5, 1000), (6, 10), (7, 14)]),
    ]
    assert len(sequences) == 3


def lengths_of_all_tiers():
    draw, bounds = random.Random(3), (0, *P.TIERS)
    routed = draw.choices(range(len(P.TIERS)), weights=(12, 4, 2, 1), k=6000)  # gaps of longer windows take many short ones
    return [draw.randrange(bounds[tier], bounds[tier + 1]) + 1 for tier in routed]


def test_each_tier_has_windows_of_its_own_size():
    sequences = P.pack(lengths_of_all_tiers())
    windows = Counter(tier for tier, _ in sequences)
    assert all(windows[tier] > 100 for tier in P.TIERS)
    assert sum(n for tier, n in windows.items() if tier not in P.TIERS) <= 8  # of the last window
    for tier, own in sequences:
        if tier in P.TIERS:
            assert all(piece.length <= tier for piece in own)


def test_steps_are_balanced():
    sequences = P.pack(lengths_of_all_tiers())
    steps = P.step_groups(sequences)
    cost, size, tiers = defaultdict(int), defaultdict(int), defaultdict(set)
    for (tier, own), step in zip(sequences, steps):
        cost[step] += sum(p.length**2 for p in own)
        size[step] += 1
        tiers[step].add(max(tier, P.TIERS[0]))
    assert all(len(own) == 1 for own in tiers.values())
    for tier in P.TIERS:
        groups = [step for step in tiers if tiers[step] == {tier}]
        assert groups and max(size[step] for step in groups) <= P.STEP * P.WINDOW // tier
        assert max(cost[step] for step in groups) <= 1.1 * min(cost[step] for step in groups)


def test_odd_documents(odd_docs, no_docs, tokenizer):
    rows = P.pack_documents(odd_docs).collect()
    totals = sorted(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(r.length for r in rows) == sum(totals)
    assert sorted(r.doc_tokens for r in rows if r.start == 0) == totals
    assert P.pack_documents(no_docs).collect() == []


def test_very_long_blank_runs(spark, tokenizer):
    texts = [" " * 1_500_000 + "end", "a" + "\n" * 1_500_000, "<pad> short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    ids = defaultdict(dict)
    for row in P.pack_documents(docs).collect():
        ids[row.doc_id][row.start] = np.frombuffer(row.ids, dtype="<u4").tolist()
    for doc, text in enumerate(texts):
        found = [number for _, own in sorted(ids[doc].items()) for number in own]
        assert found == [*tokenizer.encode(text).ids, P.END_TOKEN]
