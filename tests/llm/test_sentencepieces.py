"""SentencePiece encoding against the library itself, merge-dropout against a plain agenda, and round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from cartwheel.llm import sentencepieces as S
from cartwheel.llm.queries import QUERIES
from cartwheel.llm.units import unit_starts

PATH = public_tokenizers.path(S.MODEL)
PARTS = [" ", "\n", "\t", "a", "B", "é", "ß", "1", ".", "s", "  ", "漢", "😀", "\u0085", "\r\n", "x", "　", "the", "ing", "\x00"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(60))) for _ in range(600)]
    return [*made, "x" * 500, " " * 100, "the" * 100, "", " ", "<s> </s> <0x0A> <unk>"]


def pieces(texts, dropout, seed=1, ids=None):
    ids = pa.array(range(len(texts)) if ids is None else ids, pa.int64())
    return [found.tolist() for found in S.encoded(pa.array(texts, pa.string()), ids, PATH, dropout=dropout, seed=seed)]


def test_without_dropout_it_is_the_library(library, texts):
    assert pieces(texts, 0) == [library.encode(text) for text in texts]


@pytest.mark.parametrize("dropout", [0, 0.1, 0.5, 0.95])
def test_every_text_decodes_to_itself(texts, dropout):
    odd = [*texts, "a▁b ▁", "▁"]
    found = pieces(odd, dropout)
    assert [S.vocabulary(PATH).decode(np.array(ids, dtype=np.int64)).decode() for ids in found] == odd


def test_the_library_decodes_the_pieces(library, texts):
    assert [library.decode(ids) for ids in pieces(texts, 0.4)] == texts


def test_segmentations_vary_by_seed_document_and_place():
    text = " ".join(["international understanding"] * 40)
    one, same, seed, other = (pieces([text], 0.3, seed=s, ids=[i])[0] for s, i in ((1, 5), (1, 5), (2, 5), (1, 6)))
    assert one == same and one != seed and one != other
    plain = pieces([text], 0)[0]
    assert len(one) > len(plain)
    first = plain[: len(plain) // 40]
    assert one[: len(first)] * 40 != one


def mixed(value):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        value = (value ^ (value >> shift)) * factor % 2**64
    return value ^ (value >> 31)


def plain_agenda(library, unit, key, dropout):
    """A unit's pieces, by looking over all neighbours for each merge."""
    held = [(S.BLANK if letter == " " else letter, at, at + 1) for at, letter in enumerate(unit)]
    held = [(piece if piece != S.BLANK or unit[at] == " " else None, at, end) for piece, at, end in held]
    while True:
        best = None
        for at, (left, right) in enumerate(zip(held, held[1:])):
            if left[0] is None or right[0] is None:
                continue
            number = library.piece_to_id(left[0] + right[0])
            if number == library.unk_id() or not (S.vocabulary(PATH).plain.get(left[0]) and S.vocabulary(PATH).plain.get(right[0])):
                continue
            place = mixed((mixed((left[1] * 0xD1342543DE82EF95 + left[2]) % 2**64) + right[2]) % 2**64)
            if dropout and mixed(key ^ place) < int(dropout * 2**64):
                continue
            if best is None or library.get_score(number) > best[0]:
                best = (library.get_score(number), at)
        if best is None:
            break
        at = best[1]
        held[at : at + 2] = [(held[at][0] + held[at + 1][0], held[at][1], held[at + 1][2])]
    out = []
    for piece, begin, _ in held:
        number = S.vocabulary(PATH).plain.get(piece)
        out += [number] if number is not None else [library.piece_to_id(f"<0x{byte:02X}>") for byte in unit[begin].encode()]
    return out


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_dropout_against_a_plain_agenda(library, texts, dropout):
    chosen = [*texts[:150], "the quick understanding of international relations " * 5, "x" * 120, "the" * 30]
    keys = S.document_keys(pa.array(range(len(chosen)), pa.int64()), 1)
    apart = S.vocabulary(PATH).apart()
    for text, key, found in zip(chosen, keys, pieces(chosen, dropout)):
        data = np.frombuffer((" " + text if text else "").encode(), dtype=np.uint8)
        starts = unit_starts(data, np.array([0, len(data)]), apart) if len(data) else np.zeros(0, int)
        own = S.occurrence_keys(np.full(len(starts), key), np.arange(len(starts))).tolist()
        units = [data[b:e].tobytes().decode() for b, e in zip(starts, [*starts[1:], len(data)])]
        assert found == [piece for unit, k in zip(units, own) for piece in plain_agenda(library, unit, k, dropout)]


def test_a_frequent_word_has_all_its_segmentations():
    text = " ".join(["international"] * 3000)
    draw = pieces([text], 0.3)[0]
    vocabulary = S.vocabulary(PATH)
    found, word, spelled = set(), [], ""
    for piece in draw:
        word.append(piece)
        spelled += vocabulary.bytes[vocabulary.begin[piece] : vocabulary.begin[piece] + vocabulary.length[piece]].tobytes().decode()
        if spelled == " international":
            found.add(tuple(word))
            word, spelled = [], ""
    assert not word and len(found) > 100
    assert len({tuple(pieces([" ".join(["the"] * 200)], 0.1, ids=[i])[0]) for i in range(20)}) == 20


def test_memory_of_units_changes_nothing(texts, monkeypatch):
    one = pieces(texts, 0.3)
    monkeypatch.setattr(S, "LEVELS", 1)
    monkeypatch.setattr(S, "CACHED", 5)
    S._units.clear()
    assert pieces(texts, 0.3) == one
    S._units.clear()


def test_agenda_by_heap_gives_the_same_pieces(texts):
    draw = random.Random(2)
    for dropout in (0.0, 0.2, 0.6):
        encoder = S.Encoder(S.vocabulary(PATH), dropout)
        for text in texts:
            if 1 < len(text) <= 60:
                letters = S.vocabulary(PATH).letter[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
                skips = S.Dropped(np.array([draw.getrandbits(64)], dtype=np.uint64), dropout)
                found, merged = encoder._together(letters[None, :], skips)
                heap, order = encoder.by_heap(letters, skips)
                assert found[0].tolist() == heap.tolist()
                assert [int(at[0]) for _, at in merged] == order.tolist()


def test_units_of_all_lengths_are_merged_together(monkeypatch):
    """The rounds of a batch depend on its longest unit, not on how many lengths there are."""
    draw = random.Random(3)
    units = ["".join(draw.choice("etaoins漢😀") for _ in range(size)) for size in range(1, S.LONG + 1) for _ in range(8)]
    vocabulary, rounds = S.vocabulary(PATH), []
    joined = S.Vocabulary.joined
    monkeypatch.setattr(S.Vocabulary, "joined", lambda *pairs: rounds.append(1) or joined(*pairs))
    for dropout in (0.0, 0.3):
        rounds.clear()
        keys = np.array([draw.getrandbits(64) for _ in units], dtype=np.uint64)
        encoder = S.Encoder(vocabulary, dropout)
        ids, lengths = encoder([unit.encode() for unit in units], keys)
        assert len(rounds) <= 3 * S.LONG
        ends = np.cumsum(lengths)
        for at, unit in enumerate(units):
            alone, _ = encoder.by_heap(
                vocabulary.letter[np.frombuffer(unit.encode("utf-32-le"), dtype=np.uint32)], S.Dropped(keys[at : at + 1], dropout)
            )
            spelled, _ = vocabulary.spelled(alone, np.array([len(alone)]))
            assert ids[ends[at] - lengths[at] : ends[at]].tolist() == spelled.tolist()


def test_share_of_skipped_candidates():
    at = np.arange(40_000)
    share = S.skipped(at.astype(np.uint64), S.places(at % 7, at % 7 + 1, at % 7 + 2), 0.1).mean()
    assert 0.09 < share < 0.11


def test_a_unit_of_a_million_letters():
    text = "ab" * 500_000
    found = pieces([text], 0.1)[0]
    assert S.vocabulary(PATH).decode(np.array(found)).decode() == text


def test_query_is_lossless_and_repeatable(spark, sf_dir):
    one, two = (sorted(QUERIES["op8_sentencepiece"](spark, sf_dir).collect()) for _ in range(2))
    assert one == two and all(row.lossless for row in one)
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")
    found = S.encoded(rows["text"].combine_chunks(), rows["doc_id"].combine_chunks(), PATH, dropout=S.DROPOUT, seed=S.SEED)
    assert [row.n_pieces for row in one] == [len(ids) for ids in found]


def test_odd_documents(odd_docs, no_docs):
    rows = S.decode_documents(S.encode_documents(odd_docs)).collect()
    assert sorted(repr(r.text) for r in rows) == sorted(repr(r.text) for r in odd_docs.collect())
    assert all((r.ids is None) == (r.text is None) and (r.text != "" or r.ids == b"") for r in rows)
    assert set(rows[0].doc.asDict()) == {"doc_id", "row", "__sha"}
    assert S.encode_documents(no_docs).collect() == []
