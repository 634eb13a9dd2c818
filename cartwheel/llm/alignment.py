"""Two tokenizers' ids of the same texts, aligned where their tokens end together.

A text with a blank in front is cut into tokens by a byte-level BPE vocabulary (A) and by a SentencePiece model (B). Places
where a token of each ends cut both into groups; all tokens of a group are linked with each other. A link of two ids
counts as often as documents of the corpus hold it, and a document's links are weighed by these counts.

A text of any length is worked on as fragments. A fragment is a range of A's tokens and a range of B's, which need not
begin at the same byte: it has a head (up to its first cut), closed groups, and a tail (behind its last cut), or, without any cut, a head
alone. Two neighbouring ones compose: the tail of the left and the head of the right are joined and cut anew,
which closes further groups. That is associative, so the fragments of a long document, dealt to many tasks, are composed as a
tree, ``FAN`` at a time; closed groups stay behind as rows of their own. Each tokenizer has its own
places that no token reaches across, by which its ranges begin; a stretch without such a place stays in one fragment.
Documents of at most ``FRAGMENT`` bytes are one fragment, and are aligned where they are read.

Counts are gathered in two steps: blocks of about ``BLOCK`` bytes of whole documents number their distinct pairs of
ids and send each once; the corpus' counts come back to the blocks, whose documents refer to their numbers. A frequent pair costs
a row per block, not per document. Long documents send their pairs by themselves.

Defined results: null and empty texts, and those whose joined tokens of either kind differ from the text (such as texts with the
letter that SentencePiece writes for a blank), have no tokens, groups or links. Each row is a document, repeated ones as
well. Special tokens' strings are plain text. Columns other than the id are not carried.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import words
from cartwheel.llm.tables import in_arrow, numbered, saved, ship, table
from cartwheel.llm.units import Units, unit_starts

A_TOKENIZER, B_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLANK = "▁"
FRAGMENT = 64 << 10  # bytes of a fragment, and of a document that is one
BLOCK = 4 << 20  # bytes of documents whose pairs are numbered together
SLICE = 1 << 20  # bytes of documents aligned together
FAN = 16  # fragments composed by one task
WIDE = 4096  # links of a group that are listed; those of larger groups are counted by distinct ids
BATCH = 10_000  # units given to a tokenizer at once

DIGITS = np.array([10, 100, 1000, 10_000])


class Tokenizer:
    """The bytes of each id, the ids of units, and where units may begin. The id ``size`` marks a unit that its tokens do not make up."""

    def __init__(self, texts: list[bytes], encode: Callable[[list[str]], list[list[int]]], apart: np.ndarray):
        self.texts, self.size = texts, len(texts)
        self.lengths = np.array([*map(len, texts), 0], dtype=np.int64)
        self.encode, self.apart = encode, apart.ravel()
        self.units = Units(self._encode, self.apart)

    def _encode(self, units: Sequence[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int]] = []
        for begin in range(0, len(units), BATCH):
            part = units[begin : begin + BATCH]
            for unit, ids in zip(part, self.encode([unit.decode("utf-8") for unit in part])):
                found.append(ids if b"".join(map(self.texts.__getitem__, ids)) == unit else [self.size])
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((number for ids in found for number in ids), np.int32, int(lengths.sum())), lengths

    def ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        return self.units.texts(column, lambda hashed, before, first: hashed)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: visible ones stand for themselves, the others for 256 and on."""
    visible = [byte for byte in range(256) if 0x21 <= byte <= 0x7E or (byte >= 0xA1 and byte != 0xAD)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(byte): byte for byte in visible} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


def _byte_level_apart() -> np.ndarray:
    """Where the pattern of byte-level BPE always begins a new match: where the kind of letter changes, but not behind
    white space, which may belong to what follows, nor between an apostrophe and a letter."""
    kind = np.array(["other"] * 128 + ["wide"] * 128, dtype=object)
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = "letter"
    kind[0x30:0x3A] = "digit"
    kind[[0x20, *range(0x09, 0x0E)]] = "space"
    kind[0x1C:0x20] = "unsure"
    kind[ord("'")] = "quote"
    # Last bytes of white space beyond ASCII; a blank behind it need not begin a match.
    kind[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = "unsure"
    changes = {
        "letter": ("digit", "other", "quote", "space"),
        "digit": ("letter", "other", "quote", "space"),
        "other": ("letter", "digit", "space"),
        "quote": ("digit", "space"),
        "wide": ("space",),
    }
    return np.array([[after in changes.get(before, ()) for after in kind] for before in kind])


def byte_level(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    model = tokenizers.Tokenizer.from_file(path)
    model.encode_special_tokens = True
    byte, texts = _byte_letters(), [b""] * model.get_vocab_size()
    for token, number in model.get_vocab().items():
        texts[number] = bytes(map(byte.__getitem__, token))

    def encode(units: list[str]) -> list[list[int]]:
        return [found.ids for found in model.encode_batch(units, add_special_tokens=False)]

    return Tokenizer(texts, encode, _byte_level_apart())


def piece_level(path: str) -> Tokenizer:
    """Units begin with a blank, which is the one that the model puts in front."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(number) for number in range(size)]
    texts = [
        bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(BLANK, " ").encode()
        for number, piece in enumerate(pieces)
    ]
    apart = np.zeros((256, 256), dtype=bool)
    apart[:, 0x20] = True
    apart[0x20, 0x20] = False
    for piece in pieces:
        for before, letter in zip(piece, piece[1:]):
            if letter == BLANK:
                apart[before.replace(BLANK, " ").encode()[-1], 0x20] = False
    blank = model.piece_to_id(BLANK)

    def encode(units: list[str]) -> list[list[int]]:
        found = model.encode([unit[1:] for unit in units], num_threads=1)
        return [ids if unit != " " else [blank] for unit, ids in zip(units, found)]

    return Tokenizer(texts, encode, apart)


_known: dict[tuple[str, str], tuple[Tokenizer, Tokenizer]] = {}


def tokenizers_of(a: str, b: str) -> tuple[Tokenizer, Tokenizer]:
    """Both tokenizers, loaded once by a worker."""
    if (a, b) not in _known:
        _known[a, b] = byte_level(a), piece_level(b)
    return _known[a, b]


class Tokens(NamedTuple):
    """Neighbouring tokens of both kinds, and where they end in the text."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:  # type: ignore[override]
        return Tokens(*(np.concatenate(pair) for pair in zip(self, other)))

    def cut(self, *places: int) -> list[Tokens]:
        """The tokens that end up to each place, and the rest."""
        at_a = [0, *np.searchsorted(self.a_end, places, side="right"), len(self.a)]
        at_b = [0, *np.searchsorted(self.b_end, places, side="right"), len(self.b)]
        return [
            Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])
            for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:])
        ]

    def empty(self) -> bool:
        return not len(self.a) and not len(self.b)


NO_TOKENS = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


def common_ends(tokens: Tokens) -> np.ndarray:
    return np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)


class Closed(NamedTuple):
    """Closed groups: the tokens, how many of each kind every group has, and where it ends."""

    tokens: Tokens
    p: np.ndarray
    q: np.ndarray
    ends: np.ndarray


def closed_groups(tokens: Tokens) -> Closed:
    """The groups of tokens of which the last end together."""
    ends = common_ends(tokens)
    p = np.diff(np.searchsorted(tokens.a_end, ends, side="right"), prepend=0)
    q = np.diff(np.searchsorted(tokens.b_end, ends, side="right"), prepend=0)
    return Closed(tokens, p, q, ends)


def links(groups: Closed, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair of ids (a * width + b) and how often, for the links of all groups; large groups list a pair once."""
    a, b, p, q = groups.tokens.a.astype(np.int64), groups.tokens.b.astype(np.int64), groups.p, groups.q
    first_a, first_b = np.cumsum(p) - p, np.cumsum(q) - q
    listed = np.flatnonzero(p * q <= WIDE)
    sizes = (p * q)[listed]
    group = np.repeat(listed, sizes)
    place = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    across = q[group]
    pairs = a[first_a[group] + place // across] * width + b[first_b[group] + place % across]
    found = [(group, pairs, np.ones(len(group), np.int64))]
    for large in np.flatnonzero(p * q > WIDE):
        own_a, times_a = np.unique(a[first_a[large] : first_a[large] + p[large]], return_counts=True)
        own_b, times_b = np.unique(b[first_b[large] : first_b[large] + q[large]], return_counts=True)
        made = (own_a[:, None] * width + own_b[None, :]).ravel()
        found.append((np.full(len(made), large), made, np.outer(times_a, times_b).ravel()))
    return tuple(map(np.concatenate, zip(*found)))  # type: ignore[return-value]


def distinct_pairs(row: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and how often, once for each row and pair, in order."""
    order = np.lexsort((pairs, row)) if len(row) and row.max() >= 1 << 31 else np.argsort(row * (1 << 32) + pairs)
    row, pairs, times = row[order], pairs[order], times[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (pairs[1:] != pairs[:-1])]) if len(row) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return row[at], pairs[at], np.add.reduceat(times, at) if len(at) else times


def written(groups: Closed) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text (ids with commas, a bar between both kinds, a semicolon behind each group) and where each group's ends."""
    p, q = groups.p, groups.q
    total_a, total_b = int(p.sum()), int(q.sum())
    ids, mark = np.empty(total_a + total_b, np.int64), np.full(total_a + total_b, ord(","), np.uint8)
    ids[np.arange(total_a) + np.repeat(np.cumsum(q) - q, p)] = groups.tokens.a[:total_a]
    ids[np.arange(total_b) + np.repeat(np.cumsum(p), q)] = groups.tokens.b[:total_b]
    last = np.cumsum(p + q) - 1
    mark[last - q] = ord("|")
    mark[last] = ord(";")
    digits = 1 + np.searchsorted(DIGITS, ids, side="right")
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    for digit in range(len(DIGITS) + 1):
        long = digits > digit
        out[ends[long] - 2 - digit] = ord("0") + ids[long] // 10**digit % 10
    return out, ends[last]


# Documents that are one fragment.

ALIGNED = (
    "block bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
    "at array<int>, times array<int>, pairs array<bigint>, held array<int>"
)


def with_blank(column: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column.cast(pa.large_string()), pa.scalar("", pa.large_string()))


@dataclass
class Block:
    """Aligned documents, as columns, with the pairs of each."""

    ids: list
    numbers: list[np.ndarray]  # n_a, n_b, n_groups, n_links
    digests: list[str]
    texts: list[str | None]
    row: list[np.ndarray]
    pairs: list[np.ndarray]
    times: list[np.ndarray]
    size: int = 0

    @classmethod
    def new(cls) -> Block:
        return cls([], [], [], [], [], [], [])

    def add(self, ids: list, found: list[tuple[np.ndarray, np.ndarray]], both: tuple[Tokenizer, Tokenizer], keep: bool) -> None:
        """Align documents whose ids of both kinds were found. Those with a marked unit, or without tokens, stay empty."""
        a, b = both
        valid = np.array([bool(len(x)) and a.size not in x and b.size not in y for x, y in found], dtype=bool)
        lists = [[pair[kind] for pair, good in zip(found, valid) if good] for kind in (0, 1)]
        counts = np.zeros((len(ids), 4), np.int64)
        digests, texts = [""] * len(ids), [""] * len(ids) if keep else [None] * len(ids)
        if any(valid):
            flat = [np.concatenate(own) for own in lists]
            ends = [np.cumsum(kind.lengths[own]) for kind, own in zip(both, flat)]
            groups = closed_groups(Tokens(flat[0], ends[0], flat[1], ends[1]))
            last_a = np.cumsum([len(own) for own in lists[0]])
            stops = np.searchsorted(groups.ends, ends[0][last_a - 1]) + 1  # groups up to the end of each document
            starts = np.concatenate([[0], stops[:-1]])
            products = np.concatenate([[0], np.cumsum(groups.p * groups.q)])
            rows = np.flatnonzero(valid)
            counts[rows] = np.column_stack(
                [[len(own) for own in lists[0]], [len(own) for own in lists[1]], stops - starts, products[stops] - products[starts]]
            )
            text, text_ends = written(groups)
            view = memoryview(text)
            for row, start, stop in zip(rows.tolist(), starts.tolist(), stops.tolist()):
                own = view[text_ends[start - 1] if start else 0 : text_ends[stop - 1] - 1]
                digests[row] = hashlib.sha256(own).hexdigest()
                if keep:
                    texts[row] = bytes(own).decode()
            group, pairs, times = links(groups, b.size)
            group_row = np.repeat(rows, stops - starts)
            row, pairs, times = distinct_pairs(group_row[group], pairs, times)
            self.row.append(row + len(self.ids))
            self.pairs.append(pairs)
            self.times.append(times)
        self.ids += ids
        self.numbers.append(counts)
        self.digests += digests
        self.texts += texts

    def batch(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        """A row for each document, then one with the pairs they refer to."""
        nothing = [np.zeros(0, np.int64)]
        row, pairs, times = (np.concatenate([*part, *nothing]) for part in (self.row, self.pairs, self.times))
        own, at, held = np.unique(pairs, return_inverse=True, return_counts=True)
        counts = np.concatenate(self.numbers)
        places = pa.array(np.searchsorted(row, np.arange(len(self.ids) + 1)), pa.int32())

        def last(values, kind) -> pa.Array:
            return pa.concat_arrays([pa.nulls(len(self.ids), kind), pa.array([values], kind)])

        columns = [
            pa.array([*self.ids, None], id_type),
            pa.array(np.full(len(self.ids) + 1, number, np.int64)),
            *(pa.array([*column.tolist(), None], pa.int64()) for column in counts.T),
            pa.array([*self.digests, None], pa.string()),
            pa.array([*self.texts, None], pa.string()),
            *(
                pa.concat_arrays([pa.ListArray.from_arrays(places, pa.array(values, pa.int32())), pa.nulls(1, pa.list_(pa.int32()))])
                for values in (at.astype(np.int64), times)
            ),
            last(own, pa.list_(pa.int64())),
            last(held, pa.list_(pa.int32())),
        ]
        names = ["doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "at", "times", "pairs", "held"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def aligned_blocks(docs: DataFrame, a: str, b: str, keep: bool) -> DataFrame:
    """Documents (``doc_id``, ``text``) aligned in blocks; the last row of a block holds its distinct pairs."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(a, b)
        number = TaskContext.get().partitionId() << 32
        id_type, block = None, Block.new()
        for batch in batches:
            id_type = batch.column("doc_id").type
            texts = pc.fill_null(batch.column("text"), "")
            for begin, end in words.slices(texts, SLICE):
                part = texts.slice(begin, end - begin)
                framed = with_blank(part)
                found = list(zip(both[0].ids(framed), both[1].ids(framed)))
                filled = pc.binary_length(part).to_numpy(zero_copy_only=False) > 0
                none = (np.zeros(0, np.int32),) * 2
                found = [pair if some else none for pair, some in zip(found, filled)]
                block.add(batch.column("doc_id").slice(begin, end - begin).to_pylist(), found, both, keep)
                block.size += part.nbytes
                if block.size >= BLOCK:
                    yield block.batch(number, id_type)
                    number, block = number + 1, Block.new()
        if block.ids:
            yield block.batch(number, id_type)

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(ALIGNED).fields])
    return in_arrow(docs.select("doc_id", "text"), blocks, schema)


# Documents of several fragments.


@dataclass
class Fragment:
    """What is open of a stretch of a document: before its first cut and behind its last. Without a cut all is in the head."""

    cut: bool
    head: Tokens
    tail: Tokens

    @classmethod
    def of(cls, tokens: Tokens) -> tuple[Fragment, list[Tokens]]:
        return compose(cls(False, NO_TOKENS, NO_TOKENS), cls(False, tokens, NO_TOKENS))


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, list[Tokens]]:
    """Both as one fragment, and the tokens of groups that are closed thereby."""
    middle = (left.tail if left.cut else left.head) + right.head
    ends = common_ends(middle)
    if not len(ends):
        return (Fragment(True, left.head, middle) if left.cut else Fragment(False, middle, NO_TOKENS)), []
    head, closed, rest = middle.cut(ends[0], ends[-1])
    if left.cut:
        head, closed = left.head, head + closed
    return Fragment(True, head, right.tail if right.cut else rest), [] if closed.empty() else [closed]


SIDES = [f"{part}_{name}" for part in ("head", "tail") for name in Tokens._fields]
NODE_FIELDS = (
    ("row", "bigint"), ("fragment", "int"), ("cut", "boolean"), *((side, "array<bigint>") for side in SIDES), ("ok", "boolean"),
    ("n_a", "bigint"), ("n_b", "bigint"), ("at", "bigint"), ("groups", "binary"), ("n_groups", "bigint"), ("n_links", "bigint"),
    ("pairs", "array<bigint>"), ("times", "array<bigint>"),
)
NODE = ", ".join(f"{name} {kind}" for name, kind in NODE_FIELDS)


def _open_row(row: int, fragment: int, found: Fragment, ok: bool = True, n_a: int = 0, n_b: int = 0) -> dict:
    sides = dict(zip(SIDES, (*found.head, *found.tail)))
    return {"row": row, "fragment": fragment, "cut": found.cut, **sides, "ok": ok, "n_a": n_a, "n_b": n_b}


def _closed_row(row: int, tokens: Tokens, width: int) -> dict:
    groups = closed_groups(tokens)
    _, pairs, times = links(groups, width)
    _, pairs, times = distinct_pairs(np.zeros(len(pairs), np.int64), pairs, times)
    return {
        "row": row, "at": int(groups.ends[0]), "groups": written(groups)[0].tobytes(), "n_groups": len(groups.p),
        "n_links": int((groups.p * groups.q).sum()), "pairs": pairs, "times": times,
    }


def _nodes(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame({name: pd.Series([row.get(name) for row in rows], dtype=object) for name, _ in NODE_FIELDS})
    whole = {name: "Int64" for name in ("row", "n_a", "n_b", "at", "n_groups", "n_links")} | {"fragment": "Int32"}
    return frame.astype(whole | {"cut": "boolean", "ok": "boolean"})


def fragments(docs: DataFrame, a: str, b: str, size: int = FRAGMENT) -> DataFrame:
    """Ranges of the texts (``row``, ``text``), one row each, dealt to all tasks."""
    schema = "row bigint, fragment int, a_start bigint, a_text string, b_start bigint, b_text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(a, b)
        for batch in batches:
            for at in range(len(batch)):
                data, offsets = words.text_bytes(with_blank(batch.column("text").slice(at, 1)))
                targets = np.arange(0, len(data), size)
                bounds = []
                for kind in both:
                    starts = np.append(unit_starts(data, offsets, kind.apart), len(data))
                    bounds.append([*starts[np.searchsorted(starts, targets)].tolist(), len(data)])
                row, raw = batch.column("row")[at].as_py(), data.tobytes()
                for number in range(len(targets)):
                    columns = [pa.array([row], pa.int64()), pa.array([number], pa.int32())]
                    for bound in bounds:
                        text = raw[bound[number] : bound[number + 1]].decode("utf-8")
                        columns += [pa.array([bound[number]], pa.int64()), pa.array([text], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "fragment", "a_start", "a_text", "b_start", "b_text"])

    return in_arrow(docs.select("row", "text"), cut, schema).repartition("row", "fragment")


def _leaves(cuts: DataFrame, a: str, b: str) -> DataFrame:
    """Each fragment's open ends, and its closed groups as a row of their own."""

    def aligned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = tokenizers_of(a, b)
        for frame in frames:
            for at in range(len(frame)):
                one = frame.iloc[at]
                ids, ends = [], []
                for kind, side in zip(both, "ab"):
                    (own,) = kind.ids(pa.array([one[f"{side}_text"]], pa.string()))
                    ids.append(own.astype(np.int64))
                    ends.append(int(one[f"{side}_start"]) + np.cumsum(kind.lengths[own]))
                row, number = int(one["row"]), int(one["fragment"])
                if any((own == kind.size).any() for kind, own in zip(both, ids)):
                    yield _nodes([_open_row(row, number, Fragment(False, NO_TOKENS, NO_TOKENS), ok=False)])
                    continue
                found, closed = Fragment.of(Tokens(ids[0], ends[0], ids[1], ends[1]))
                made = [_closed_row(row, tokens, both[1].size) for tokens in closed]
                yield _nodes([_open_row(row, number, found, True, len(ids[0]), len(ids[1])), *made])

    return cuts.mapInPandas(aligned, NODE)


def _read_open(one: pd.Series) -> Fragment:
    sides = [np.asarray(one[side], dtype=np.int64) for side in SIDES]
    return Fragment(bool(one["cut"]), Tokens(*sides[:4]), Tokens(*sides[4:]))


def _composed(width: int, fan: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def parent(children: pd.DataFrame) -> pd.DataFrame:
        children = children.sort_values("fragment")
        row, rows = int(children["row"].iloc[0]), []
        made, *others = [_read_open(one) for _, one in children.iterrows()]
        for other in others:
            made, closed = compose(made, other)
            rows += [_closed_row(row, tokens, width) for tokens in closed]
        return _nodes([_open_row(row, int(children["fragment"].iloc[0]) // fan, made), *rows])

    return parent


def _roots(width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The group that begins a document; it is whole if nothing is left open at its end."""

    def ended(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for _, one in frame.iterrows():
                whole, row = _read_open(one), int(one["row"])
                if whole.cut and whole.tail.empty():
                    rows.append(_closed_row(row, whole.head, width))
                else:
                    rows.append({"row": row, "ok": False})
            yield _nodes(rows)

    return ended


def _digests(pieces: DataFrame, keep: bool) -> DataFrame:
    """The digest of each document's groups, fed piece by piece in order."""

    def fed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, texts, last = None, hashlib.sha256(), [], b""

        def finished() -> pa.RecordBatch:
            digest.update(last[:-1])
            text = (b"".join(texts) + last[:-1]).decode() if keep else None
            columns = [pa.array([current], pa.int64()), pa.array([digest.hexdigest()]), pa.array([text], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["row", "groups_sha256", "groups"])

        for batch in batches:
            for row, piece in zip(batch.column("row").to_pylist(), batch.column("groups")):
                if row != current:
                    if current is not None:
                        yield finished()
                    current, digest, texts, last = row, hashlib.sha256(), [], b""
                digest.update(last)
                if keep:
                    texts.append(last)
                last = piece.as_py()
        if current is not None:
            yield finished()

    ordered = pieces.select("row", "at", "groups").repartition("row").sortWithinPartitions("row", "at")
    return in_arrow(ordered, fed, "row bigint, groups_sha256 string, groups string")


def aligned_long(docs: DataFrame, a: str, b: str, keep: bool, size: int = FRAGMENT, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Documents (``row``, ``doc_id``, ``text``) aligned by a tree of fragments: their totals, and row, pair and how often."""
    ship(docs.sparkSession)
    width = _width(b)
    nodes = saved(_leaves(fragments(docs, a, b, size), a, b), "fragments")
    leaves = nodes.where("fragment IS NOT NULL")
    totals = leaves.groupBy("row").agg(F.min("ok").alias("ok"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    pieces, still_open = [nodes.where("fragment IS NULL")], leaves.where("ok")
    while still_open.agg(F.coalesce(F.max("fragment"), F.lit(0))).first()[0] > 0:
        parents = still_open.withColumn("parent", F.floor(F.col("fragment") / fan))
        nodes = saved(parents.groupBy("row", "parent").applyInPandas(_composed(width, fan), NODE), "composed")
        pieces.append(nodes.where("fragment IS NULL"))
        still_open = nodes.where("fragment IS NOT NULL")
    ended = saved(still_open.mapInPandas(_roots(width), NODE), "roots")
    pieces.append(ended.where("ok IS NULL"))
    whole = totals.where("ok").join(ended.where("NOT ok").select("row"), "row", "left_anti").select("row", "n_a", "n_b")
    whole = saved(whole, "whole-documents")
    parts = reduce(DataFrame.unionByName, pieces).join(whole.select("row"), "row", "left_semi")
    sums = parts.groupBy("row").agg(F.sum("n_groups").alias("n_groups"), F.sum("n_links").alias("n_links"))
    pairs = (
        parts.select("row", F.inline(F.arrays_zip("pairs", "times")))
        .groupBy("row", F.col("pairs").alias("pair"))
        .agg(F.sum("times").alias("times"))
    )
    found = docs.select("row", "doc_id").join(whole.join(sums, "row").join(_digests(parts, keep), "row"), "row", "left")
    return found, saved(pairs, "long-pairs")


def _width(b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()


# Counts of the corpus.


def _weighed(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of a block with the counts of their pairs."""
    at = answers.column("at").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at] = answers.column("count").to_numpy()
    best[at] = answers.column("best").to_numpy(zero_copy_only=False)
    sums: list[list[int]] = [[], []]
    for chunk_at, chunk_times in zip(docs.column("at").chunks, docs.column("times").chunks):
        offsets = chunk_at.offsets.to_numpy() - chunk_at.offsets[0].as_py()
        places, times = chunk_at.flatten().to_numpy(), chunk_times.flatten().to_numpy().astype(np.int64)
        for total, value in zip(sums, (best, count)):
            reached = np.concatenate([[0], np.cumsum(value[places] * times)])
            total += (reached[offsets[1:]] - reached[offsets[:-1]]).tolist()
    kept = docs.drop_columns(["at", "times", "own_block"])
    return kept.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def aligned(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    a: str | None = None,
    b: str | None = None,
    keep_groups: bool = False,
    fragment: int = FRAGMENT,
    fan: int = FAN,
) -> DataFrame:
    """One row per document: its tokens, groups and links counted, the groups' digest (and text, if kept), and its links weighed by the corpus."""
    a, b = a or public_tokenizers.path(A_TOKENIZER), b or public_tokenizers.path(B_MODEL)
    read = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > fragment
    blocks = saved(aligned_blocks(read.where(~is_long), a, b, keep_groups), "aligned")
    long, long_pairs = aligned_long(numbered(read.where(is_long), "long-documents"), a, b, keep_groups, fragment, fan)

    asked = blocks.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "pair"))
    asked = asked.select("block", "at", F.col("pair.pairs").alias("pair"), F.col("pair.held").alias("held"))
    width = _width(b)
    held = asked.select("pair", "held").unionByName(long_pairs.select("pair", F.lit(1).alias("held")))
    counts = saved(held.groupBy("pair").agg(F.sum("held").alias("count")), "pair-counts")
    highest = counts.groupBy(F.floor(F.col("pair") / width).alias("a")).agg(F.max("count").alias("highest"))
    ranked = counts.withColumn("a", F.floor(F.col("pair") / width)).join(highest, "a")
    ranked = saved(ranked.select("pair", "count", (F.col("count") == F.col("highest")).cast("bigint").alias("best")), "ranked-pairs")

    ship(docs.sparkSession)
    rows = blocks.where("pairs IS NULL").drop("pairs", "held").withColumnRenamed("block", "own_block")
    answers = asked.join(ranked, "pair").select("block", "at", "count", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "n_best", "count_sum"]
    schema = T.StructType([rows.schema[name] for name in names[:7]] + [T.StructField(name, T.LongType()) for name in names[7:]])
    short = rows.groupBy("own_block").cogroup(answers.groupBy("block")).applyInArrow(_weighed, schema)

    sums = long_pairs.join(ranked, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    empty = {name: 0 for name in names[1:5] + names[7:]} | {"groups_sha256": "", "groups": ""}
    weighed = long.join(sums, "row", "left").select(*names).fillna({name: value for name, value in empty.items()})
    result = short.unionByName(weighed)
    return result if keep_groups else result.drop("groups")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))
