"""Words of Arrow text columns as NumPy arrays: spans, 64-bit hashes, shingles.

Texts are handled as UTF-8 bytes. Separators are ASCII, so a byte test is enough to find
the words, and only A-Z change when case is folded. Only one byte per byte of text and two
integers per word are held for a batch; the wider arrays cover a window of it at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 18  # bytes of text hashed at once
SLICE = 1 << 21  # bytes of text a caller should handle at once
LONG_WORD = 1 << 10  # bytes; longer words are hashed one by one

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0xD1342543DE82EF95)


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of unsigned 64-bit integers."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWER = _powers(_BASE, WINDOW + LONG_WORD + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), WINDOW + LONG_WORD + 1)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

BLANKS = bytes([0x20, *range(0x09, 0x0E)])


def separators(blanks: bytes) -> np.ndarray:
    """True for each byte value that separates words."""
    table = np.zeros(256, dtype=bool)
    table[list(blanks)] = True
    return table


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each text begins (with the end of the last). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text; a longer text makes a range of its own."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, held = 0, 0
    for row, length in enumerate(lengths):
        if row > begin and held + length > size:
            yield begin, row
            begin, held = row, 0
        held += int(length)
    if begin < len(lengths):
        yield begin, len(lengths)


def spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (with the total at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~blank[data]
    begins = np.empty(len(data), dtype=bool)
    begins[0] = inside[0]
    np.logical_and(inside[1:], ~inside[:-1], out=begins[1:])
    ends = np.empty(len(data), dtype=bool)
    ends[-1] = inside[-1]
    np.logical_and(inside[:-1], ~inside[1:], out=ends[:-1])
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, *, fold: bool) -> np.ndarray:
    """A 64-bit hash of each word; ``fold`` lower-cases A-Z first."""
    out = np.zeros(len(starts), dtype=np.uint64)
    lengths = stops - starts
    begin = 0
    while begin < len(starts):
        base = starts[begin]
        end = max(begin + 1, int(np.searchsorted(stops, base + WINDOW, side="right")))
        if end == begin + 1 and lengths[begin] > WINDOW:
            begin = end
            continue
        piece = data[base : stops[end - 1]]
        values = _BYTE[_FOLD[piece] if fold else piece] * _POWER[: len(piece)]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(values, out=sums[1:])
        low, high = starts[begin:end] - base, stops[begin:end] - base
        out[begin:end] = mix((sums[high] - sums[low]) * _INVERSE[low] + (high - low).astype(np.uint64))
        begin = end
    for word in np.flatnonzero(lengths > LONG_WORD):
        piece = data[starts[word] : stops[word]]
        digest = hashlib.blake2b((_FOLD[piece] if fold else piece).tobytes(), digest_size=8).digest()
        out[word] = np.frombuffer(digest, dtype=np.uint64)[0]
    return out


def chained(words: np.ndarray, count: int) -> np.ndarray:
    """The hash of each run of ``count`` words."""
    total = len(words) - count + 1
    value = np.full(max(total, 0), count, dtype=np.uint64)
    for place in range(count):
        value = value * STEP + words[place : place + len(value)]
    return mix(value)


def distinct(hashed: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    ordered = np.sort(hashed)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted; a shorter text is one shingle, one without words has none."""
    blank = separators(BLANKS)
    for begin, end in slices(column):
        data, offsets = text_bytes(column.slice(begin, end - begin))
        starts, stops, before = spans(data, offsets, blank)
        words = hashes(data, starts, stops, fold=True)
        runs = chained(words, size)
        for row in range(end - begin):
            low, high = int(before[row]), int(before[row + 1])
            yield distinct(runs[low : high - size + 1] if high - low >= size else chained(words[low:high], max(high - low, 1)))
