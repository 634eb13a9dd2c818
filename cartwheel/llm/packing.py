"""Packing of tokenised documents into windows of several context sizes.

Documents are routed to tiers by length. Whole windows of the largest size are cut off long documents; what
remains of each goes to the smallest tier that holds it, and is not cut again unless a gap needs it. Tiers
are packed from the longest down, each into windows of its own size: a piece opens a window and its gap is filled
with the longest waiting pieces that fit, first of its own and then of shorter tiers. A window that stays short is
filled by cutting a waiting piece. Only the last window of a buffer may find none; it is cut down to windows of smaller
powers of two. So all windows are full, and as each is a power of two long, none is padded. The sequences of a tier are
then dealt to step groups of about as many tokens and of similar cost (the sum of squared piece lengths, which attention
pays): the costliest in turn to the group with the least cost so far. What is shorter than any tier goes with the shortest.

Each partition of the input is packed by itself in a stream: a buffer of at most ``BUFFER`` tokens is packed
whenever it is full, so memory is bounded, no token is shuffled and no group can be too large. Recomputing a partition gives
the same result, provided it reads the same rows in the same order, as a table's partitions do.

Defined results: null text counts as empty; an empty document is its end token alone; each row is packed,
repeated ones as well. Columns other than the id and the text are not carried.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import in_arrow, small_batches, table

TOKENIZER = "byte_bpe_50k.json"
END_TOKEN = 1
WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
BUFFER = 1 << 20
STEP = 32  # sequences of one step group of the longest tier; as many tokens of shorter ones
OUT_ROWS = 2048

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_id bigint"
)

_encoders: dict[str, tiktoken.Encoding] = {}
_slow_encoders: dict[str, tokenizers.Tokenizer] = {}


def _byte_values() -> dict[str, int]:
    """The characters that byte-level tokenizer files write for bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level tokenizer file, one for each worker.

    Its ids are those of the ``tokenizers`` library for the same file, which tests hold it to, at two to
    four times the speed.
    """
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {added["content"]: added["id"] for added in described["added_tokens"]}
        byte = _byte_values()
        ranks = {
            bytes(byte[letter] for letter in token): number
            for token, number in described["model"]["vocab"].items()
            if token not in special
        }
        _encoders[path] = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
    return _encoders[path]


def encoded(path: str, text: str) -> list[int]:
    """The ids of a text; of one with a run of blanks too long for the pattern in ``tiktoken``, by ``tokenizers``."""
    try:
        return encoder(path).encode(text, allowed_special="all")
    except ValueError:
        if path not in _slow_encoders:
            _slow_encoders[path] = tokenizers.Tokenizer.from_file(path)
        return list(_slow_encoders[path].encode(text, add_special_tokens=False).ids)


@dataclass
class Piece:
    doc: int  # place in the buffer
    start: int
    length: int


class Shelf:
    """Waiting pieces, by length."""

    def __init__(self, pieces: list[Piece]):
        self.by_length: dict[int, list[Piece]] = {}
        for piece in pieces:
            self.by_length.setdefault(piece.length, []).append(piece)
        for same in self.by_length.values():
            same.reverse()
        self.lengths = sorted(self.by_length)

    def __bool__(self) -> bool:
        return bool(self.lengths)

    def take(self, most: int) -> Piece | None:
        """The longest piece of at most this length, the earliest of equals."""
        at = bisect_right(self.lengths, most) - 1
        if at < 0:
            return None
        length = self.lengths[at]
        same = self.by_length[length]
        piece = same.pop()
        if not same:
            del self.by_length[length]
            self.lengths.pop(at)
        return piece

    def put(self, piece: Piece) -> None:
        if piece.length not in self.by_length:
            self.by_length[piece.length] = []
            insort(self.lengths, piece.length)
        self.by_length[piece.length].append(piece)


def pack(lengths: list[int]) -> list[tuple[int, list[Piece]]]:
    """Sequences (tier, pieces) for documents of these lengths."""
    sequences: list[tuple[int, list[Piece]]] = []
    rests = []
    for doc, length in enumerate(lengths):
        whole = length // WINDOW * WINDOW
        sequences += [(WINDOW, [Piece(doc, start, WINDOW)]) for start in range(0, whole, WINDOW)]
        if length > whole:
            rests.append(Piece(doc, whole, length - whole))
    bounds = (0, *TIERS)
    shelves = [Shelf([p for p in rests if low < p.length <= high]) for low, high in zip(bounds, TIERS)]
    for tier in reversed(range(len(TIERS))):
        while shelves[tier]:
            window, gap = [], TIERS[tier]
            while gap:
                fitting = (shelves[k].take(gap) for k in range(tier, -1, -1))
                piece = next((p for p in fitting if p is not None), None)
                if piece is None:
                    longer = next((shelf for shelf in shelves if shelf), None)
                    if longer is None:
                        break
                    whole = longer.take(WINDOW)
                    piece = Piece(whole.doc, whole.start, gap)
                    rest = Piece(whole.doc, whole.start + gap, whole.length - gap)
                    shelves[next(k for k, size in enumerate(TIERS) if rest.length <= size)].put(rest)
                window.append(piece)
                gap -= piece.length
            sequences += [(TIERS[tier], window)] if not gap else _powers_of_two(window)
    return sequences


def _powers_of_two(window: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """A short window as windows of falling powers of two, filled without a gap."""
    waiting = [Piece(p.doc, p.start, p.length) for p in reversed(window)]
    left, out = sum(p.length for p in window), []
    while left:
        size = 1 << (left.bit_length() - 1)
        filled, gap = [], size
        while gap:
            piece = waiting.pop()
            if piece.length > gap:
                waiting.append(Piece(piece.doc, piece.start + gap, piece.length - gap))
                piece = Piece(piece.doc, piece.start, gap)
            filled.append(piece)
            gap -= piece.length
        out.append((size, filled))
        left -= size
    return out


def step_groups(sequences: list[tuple[int, list[Piece]]]) -> list[int]:
    """A step group for each sequence: of one tier, of ``STEP`` windows' tokens at most, and of balanced cost within the tier."""
    out, first = [0] * len(sequences), 0
    for tier, shorter in zip(TIERS, (0, *TIERS)):
        own = [at for at, (size, _) in enumerate(sequences) if shorter < size <= tier]
        most = STEP * (WINDOW // tier)
        groups = -(-len(own) // most)
        cost = {at: sum(p.length**2 for p in sequences[at][1]) for at in own}
        open_groups = [(0, 0, first + group) for group in range(groups)]
        for at in sorted(own, key=lambda at: (-cost[at], at)):
            load, held, group = heapq.heappop(open_groups)
            out[at] = group
            if held + 1 < most:
                heapq.heappush(open_groups, (load + cost[at], held + 1, group))
        first += groups
    return out


def _packed(ids: list, tokens: list[np.ndarray], first_sequence: int, first_step: int) -> Iterator[dict]:
    sequences = pack([len(t) for t in tokens])
    steps = step_groups(sequences)
    for number, ((tier, pieces), step) in enumerate(zip(sequences, steps)):
        offset = 0
        for piece in pieces:
            own = tokens[piece.doc]
            yield {
                "doc_id": ids[piece.doc],
                "start": piece.start,
                "length": piece.length,
                "ids": own[piece.start : piece.start + piece.length].tobytes(),
                "doc_tokens": len(own),
                "sequence_id": first_sequence + number,
                "offset": offset,
                "tier": tier,
                "step_id": first_step + step,
            }
            offset += piece.length


def pack_documents(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", tokenizer: str | None = None, end: int = END_TOKEN
) -> DataFrame:
    """The pieces of all documents, with their ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId() << 40
        sequence = step = partition
        ids: list = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, step, held
            rows: list[dict] = []
            for row in _packed(ids, tokens, sequence, step):
                rows.append(row)
                if len(rows) == OUT_ROWS:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
            sequence, step, held = sequence + (1 << 24), step + (1 << 24), 0
            ids.clear()
            tokens.clear()

        def _batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                found = encoded(path, text.as_py() or "")
                found.append(end)
                ids.append(doc.as_py())
                tokens.append(np.array(found, dtype="<u4"))
                held += len(found)
                if held >= BUFFER:
                    yield from flush()
        if ids:
            yield from flush()

    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(part.split()[0], types[part.split()[1]]) for part in PIECES.split(", ")])
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return in_arrow(rows, packed, PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of these."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack_documents(table(spark, sf_dir, "documents")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack_documents(docs)
