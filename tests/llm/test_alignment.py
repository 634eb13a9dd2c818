"""Alignments against whole texts encoded by both libraries, one document after another."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

from cartwheel.llm import alignment
from cartwheel.llm.alignment import Fragment, Tokens, aligned, compose, tokenizers_of

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def whole():
    """The ids and bytes of whole texts."""
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(byte): byte for byte in shown}
    letters |= {chr(256 + at): byte for at, byte in enumerate(byte for byte in range(256) if byte not in shown)}

    def of(text: str):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(letters[letter] for letter in a.id_to_token(number)) for number in ids_a]
        pieces = map(b.id_to_piece, ids_b)
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode() for n, p in zip(ids_b, pieces)]
        return ids_a, bytes_a, ids_b, bytes_b

    return of


def groups_of(whole, text):
    """The groups of a text as lists of ids of both kinds."""
    if not text:
        return []
    ids_a, bytes_a, ids_b, bytes_b = whole(text)
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends_a, ends_b = (np.cumsum([len(part) for part in parts]).tolist() for parts in (bytes_a, bytes_b))
    groups, own = [], ([], [])
    common = set(ends_a) & set(ends_b)
    at = 0
    for end, number in zip(ends_a, ids_a):
        own[0].append(number)
        if end in common:
            while at < len(ends_b) and ends_b[at] <= end:
                own[1].append(ids_b[at])
                at += 1
            groups.append(own)
            own = ([], [])
    return groups


def expected(whole, rows):
    """The columns of every document, from all links listed."""
    every = [(key, groups_of(whole, text)) for key, text in rows]
    counts = Counter(pair for _, groups in every for pair in {(x, y) for a, b in groups for x in a for y in b})
    highest = {}
    for (x, _), count in counts.items():
        highest[x] = max(count, highest.get(x, 0))
    out = []
    for key, groups in every:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(counts[link] == highest[link[0]] for link in links), sum(counts[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(row[name] for name in COLUMNS) for row in frame.collect()), key=repr)


def test_documents(spark, sf_dir, whole):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(alignment.op12_alignment(spark, sf_dir)) == expected(whole, [(r.doc_id, r.text) for r in docs.collect()])


STRANGE = [
    "<|endoftext|> and <s>plain</s> <0x0A> <unk>", "a▁b", " two  blanks ", "\n\tlines\r\n\n ends \n", "don't it's 'tis 'S9 a'b x'' 's5",
    "漢字かな交じり文。" * 40, "é   x　 y  z\u0085   q", "é ﬁ ① ½ 😀😀 \x00 \x1c \x1f x", "A" * 300 + "1" * 50 + "-" * 90,
    "x1y2z3" * 60, "\x1c a\x1d b", "tab\there  \t  there", " ", " ", "  ", "\n", "ﬀ‘quoted’ — dash…", "'''s' 's's", "９９ １a",
]


@pytest.mark.parametrize("fragment, fan", [(1 << 16, 16), (40, 2), (7, 3)])
def test_odd_documents_whole_and_in_fragments(spark, odd_docs, odd_texts, whole, fragment, fan):
    """Texts without places to cut, with blanks of all kinds, and texts that one side cannot write; in fragments of few bytes."""
    rows = [(r.doc_id, r.text if r.text is None or len(r.text) < 9000 else r.text[:900]) for r in odd_docs.collect()]
    rows += list(enumerate(STRANGE, 1000))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS row", "2 AS block", "3 AS n_a", "4 AS pairs")
    result = aligned(docs.repartition(3), fragment=fragment, fan=fan, keep_groups=True)
    assert found(result) == expected(whole, rows)
    for row in result.collect():
        assert row.groups_sha256 == (hashlib.sha256(row.groups.encode()).hexdigest() if row.n_a else "")


def test_a_long_document_in_fragments(spark, odd_texts, whole):
    long = max((text for text in odd_texts if text), key=len)
    rows = [(1, long), (2, long[:100_000] + "漢字" * 20_000), (3, long[5:70_000].replace(" ", "")), (4, "alpha beta"), (5, long + "▁")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(aligned(docs)) == expected(whole, rows)


def test_no_documents(spark, no_docs):
    assert aligned(no_docs).collect() == []


def test_units_make_up_whole_texts(whole):
    """Units of random letters, encoded one by one, are the tokens of the whole text."""
    draw = random.Random(4)
    letters = "ab'sSt19 \n\t-.,é漢  　\u0085​😀<>▁" + " " * 8
    both = tokenizers_of(A, B)
    texts = ["".join(draw.choices(letters, k=draw.randint(1, 40))) for _ in range(4000)]
    column = pa.array([" " + text for text in texts])
    for text, ids_a, ids_b in zip(texts, both[0].ids(column), both[1].ids(column)):
        own_a, _, own_b, bytes_b = whole(text)
        assert ids_a.tolist() == own_a, repr(text)
        if b"".join(bytes_b) == (" " + text).encode():
            assert ids_b.tolist() == own_b, repr(text)
        else:
            assert both[1].size in ids_b


def random_tokens(draw: random.Random, size: int) -> Tokens:
    ends = [sorted({size, *draw.sample(range(1, size), draw.randint(0, size // 3))}) for _ in range(2)]
    return Tokens(*(np.array(part, np.int64) for own in ends for part in ([draw.randrange(9) for _ in own], own)))


def test_composing_is_associative():
    """Any cuts of both token rows, composed in any order, leave the same open ends and close the same groups."""
    draw = random.Random(5)
    for _ in range(400):
        tokens = random_tokens(draw, 60)
        cuts = [sorted(draw.choices(range(61), k=4)) for _ in range(2)]
        parts = []
        for a_from, a_to, b_from, b_to in zip([0, *cuts[0]], [*cuts[0], 60], [0, *cuts[1]], [*cuts[1], 60]):
            a, b = (tokens.a_end > a_from) & (tokens.a_end <= a_to), (tokens.b_end > b_from) & (tokens.b_end <= b_to)
            parts.append(Tokens(tokens.a[a], tokens.a_end[a], tokens.b[b], tokens.b_end[b]))
        results = []
        for _ in range(3):
            closed, row = [], []
            for part in parts:
                fragment, own = Fragment.of(part)
                row.append(fragment)
                closed += own
            while len(row) > 1:
                at = draw.randrange(len(row) - 1)
                row[at : at + 2], own = [compose(row[at], row[at + 1])[0]], compose(row[at], row[at + 1])[1]
                closed += own
            groups = sorted(end for part in closed for end in alignment.closed_groups(part).ends.tolist())
            results.append((groups, [side.tolist() for side in (*row[0].head, *row[0].tail)]))
        assert results[0] == results[1] == results[2]
        ends = alignment.common_ends(tokens).tolist()
        assert results[0][0] == ends[1:] and row[0].tail.empty()


def test_links_of_large_groups_are_counted_by_ids(monkeypatch):
    draw = random.Random(6)
    tokens = [random_tokens(draw, 50) for _ in range(50)]
    found = []
    for wide in (1, 4, 4096):
        monkeypatch.setattr(alignment, "WIDE", wide)
        found.append([Counter() for _ in tokens])
        for own, counted in zip(tokens, found[-1]):
            for group, pair, times in zip(*(part.tolist() for part in alignment.links(alignment.closed_groups(own), 100))):
                counted[group, pair] += times
    assert found[0] == found[1] == found[2]
