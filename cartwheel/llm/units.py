"""Pieces of texts through a cache of units, the stretches of text between places that no piece reaches across.

A text's pieces are those of its units one after another. Units repeat, so each distinct one is encoded
once per worker while it stays in the cache; texts are then put together by NumPy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from cartwheel.llm import words

CACHED = 400_000  # units a worker remembers; then it starts afresh
SLICE = 2 << 20

#: Units and their keys to all ids, and how many each unit has.
Encode = Callable[[Sequence[bytes], np.ndarray], tuple[np.ndarray, np.ndarray]]


def unit_starts(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Where units begin: at each text, and between two bytes that ``apart`` (256 x 256, as one row) says no piece joins."""
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = apart[(data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]]
    edges = offsets[:-1]
    begins[edges[edges < len(data)]] = True
    return np.flatnonzero(begins)


class Units:
    """Token ids of texts, by an encoder of distinct units."""

    def __init__(self, encode: Encode, apart: np.ndarray):
        self.encode, self.apart = encode, apart
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, units: list[bytes]) -> None:
        ids, lengths = self.encode(units, keys)
        first = len(self.begin)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, ids])
        self.known.update(zip(keys.tolist(), range(first, first + len(keys))))

    def _ids(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each unit has."""
        distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHED:
            self._forget()
        listed = distinct.tolist()
        missing = [at for at, key in enumerate(listed) if key not in self.known]
        if missing:
            at = first[missing]
            raw = data.tobytes()
            self._learn(distinct[missing], [raw[b:e] for b, e in zip(starts[at].tolist(), stops[at].tolist())])
        entry = np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))[place]
        lengths = self.length[entry]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.begin[entry] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))], lengths

    def texts(self, column: pa.Array, keyed: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> Iterator[np.ndarray]:
        """The ids of each text. ``keyed`` gives the units' keys, from their hashes, the units before each text and the first row."""
        for begin, end in words.slices(column, SLICE):
            data, offsets = words.text_bytes(column.slice(begin, end - begin))
            if not len(data):
                yield from (np.zeros(0, np.int32) for _ in range(begin, end))
                continue
            starts = unit_starts(data, offsets, self.apart)
            stops = np.append(starts[1:], len(data))
            before = np.searchsorted(starts, offsets)
            keys = keyed(words.hashes(data, starts, stops, fold=False), before, begin)
            ids, lengths = self._ids(data, starts, stops, keys)
            ends = np.concatenate([[0], np.cumsum(lengths)])[before]
            for row in range(end - begin):
                yield ids[ends[row] : ends[row + 1]]
