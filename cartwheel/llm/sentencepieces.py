"""SentencePiece encoding with seeded merge-dropout, and its lossless decoding.

A BPE vocabulary is applied to a text as SentencePiece does it: a blank is put in front, blanks become a
letter of their own, and the best-scored pair of neighbouring pieces is merged (the leftmost of equals)
until no two neighbours make a piece. With dropout, each candidate merge on that agenda is skipped with
probability ``DROPOUT``, by a hash keyed with the seed, the document's id, the place of the unit (about a word and the
blanks before it) in the text and the places of both pieces in it. So every occurrence of a word is cut by decisions of its own,
which are the same in every run. Without dropout the segmentations are SentencePiece's own.

As the hash decides on a candidate the same way whenever it is looked at, the agenda needs no order of its
own: units of similar lengths are worked off together in NumPy, each round merging the best candidate left of every unit.
A worker remembers the merges of each distinct unit. An occurrence whose hashes skip none of them has those
pieces; where one is skipped, the merges of the unit without that candidate are looked up in the same way. After
``LEVELS`` skips, and if it is long, a unit is encoded by itself, with the same result.

Letters outside the vocabulary, and the letter that stands for a blank if a text holds it, are written as
bytes. Decoding joins pieces and bytes and takes the first blank off, which gives back every text exactly.

Defined results: null and empty texts have no pieces and decode to null and to the empty text; a null id
is hashed like an id of its own; repeated rows of one id get the same pieces. Other columns are carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import words
from cartwheel.llm.tables import in_arrow, table
from cartwheel.llm.units import CACHED, Units

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
DROPOUT = 0.1
LEVELS = 3  # sets of skipped candidates, by size, whose merges a worker remembers
SEED = 17
SLICE = 1 << 19  # bytes of text at once; the merges of all its units are held with their hashes, many times as much
LONG = 48  # letters; longer units go through a heap
WIDTHS = (8, 16, LONG)  # letters up to which units are worked off together
BLOCK = 1 << 13  # units at once
NONE, GONE = -1, -2  # where no letter is, and where a piece was merged into the one before
LACKING = -3  # and below: letters outside the vocabulary
SLOT_BITS = 20  # of the table of merges
NULL_ID = 0x7D1F3B9A52C84E61


def _slots(pairs: np.ndarray) -> np.ndarray:
    """Where pairs of pieces are looked up."""
    return ((pairs.view(np.uint64) * words.STEP) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Vocabulary:
    """Pieces, merges and bytes of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        self.plain = {
            model.id_to_piece(number): number
            for number in range(size)
            if not (model.is_unknown(number) or model.is_control(number) or model.is_byte(number) or model.is_unused(number))
        }
        self.byte = {int(model.id_to_piece(number)[3:5], 16): number for number in range(size) if model.is_byte(number)}
        self.of_byte = np.array([self.byte[byte] for byte in range(256)], dtype=np.int64)
        self.score = np.full(size, -np.inf)
        for number in self.plain.values():
            self.score[number] = model.get_score(number)
        self.rank = np.unique(-self.score, return_inverse=True)[1].astype(np.int64)  # from the best score, equal for equal ones
        merges = {
            (self.plain[piece[:cut]], self.plain[piece[cut:]]): number
            for piece, number in self.plain.items()
            for cut in range(1, len(piece))
            if piece[:cut] in self.plain and piece[cut:] in self.plain
        }
        self.merge = merges
        keys = np.array([left * size + right for left, right in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], np.array(list(merges.values()), dtype=np.int64)[order]
        slots = _slots(self.keys)
        self.slot = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.slot[slots] = np.arange(len(slots))
        self.shared = np.bincount(slots, minlength=1 << SLOT_BITS) > 1  # by several pairs, which are searched for
        # letters to pieces; a negative number of its own for each that is written as several bytes
        self.letter = LACKING - np.arange(0x110000)
        for byte in range(0x80):
            self.letter[byte] = self.byte[byte]
        for piece, number in self.plain.items():
            if len(piece) == 1:
                self.letter[ord(piece)] = number
        self.letter[ord(" ")] = self.letter[ord(BLANK)]
        self.letter[ord(BLANK)] = LACKING - ord(BLANK)
        texts = [b""] * size
        for piece, number in self.plain.items():
            texts[number] = piece.replace(BLANK, " ").encode()
        for byte, number in self.byte.items():
            texts[number] = bytes([byte])
        self.length = np.array([len(text) for text in texts], dtype=np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def apart(self) -> np.ndarray:
        """Pairs of bytes between which no piece reaches across: of ASCII letters, and blanks and line ends behind others."""
        table = np.zeros((256, 256), dtype=bool)
        table[:0x80, :0x80] = True
        for blank in b" \n":
            table[0x80:, blank] = True
        for piece in self.plain:
            for before, after in zip(*(piece.replace(BLANK, " ")[k:] for k in (0, 1))):
                table[before.encode()[-1], after.encode()[0]] = False
        return table.ravel()

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        wanted = np.where((left | right) >= 0, left * self.size + right, -1)
        slot = _slots(wanted)
        at = self.slot[slot]
        found = np.where(self.keys[at] == wanted, self.merged[at], -1)
        shared = np.nonzero(self.shared[slot] & (wanted >= 0))
        if len(shared[0]):
            at = np.minimum(np.searchsorted(self.keys, wanted[shared]), len(self.keys) - 1)
            found[shared] = np.where(self.keys[at] == wanted[shared], self.merged[at], -1)
        return found

    def spelled(self, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, with the bytes of letters that the vocabulary lacks, and how many each unit has."""
        lacking = np.flatnonzero(pieces < 0)
        if not len(lacking):
            return pieces, lengths
        letters = (LACKING - pieces[lacking]).astype("<u4")
        counts = np.ones(len(pieces), dtype=np.int64)
        counts[lacking] += (letters >= 0x80).astype(np.int64) + (letters >= 0x800) + (letters >= 0x10000)
        ids = np.repeat(pieces, counts)
        ids[ids < 0] = self.of_byte[np.frombuffer(letters.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)]
        before = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(lengths)
        return ids, before[ends] - before[ends - lengths]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the pieces, without the blank that encoding puts in front."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.begin[ids] - (ends - lengths), lengths)
        return self.bytes[shift + np.arange(len(shift))][1:].tobytes()


def places(begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the candidates of pieces from ``begin`` to ``middle`` to ``end``."""
    begin, middle, end = (np.asarray(at).astype(np.uint64) for at in (begin, middle, end))
    return words.mix(words.mix(begin * words.STEP + middle) + end)


def limit(dropout: float) -> np.uint64:
    return np.uint64(int(dropout * 2**64))


def skipped(keys: np.ndarray, places: np.ndarray, dropout: float) -> np.ndarray:
    """Whether candidates are skipped under the key of an occurrence."""
    return words.mix(keys ^ places) < limit(dropout)


_ALL = 2**64 - 1
_STEP, _MIX_1, _MIX_2 = (int(value) for value in (words.STEP, words._MIX_1, words._MIX_2))


def _mix(value: int) -> int:
    """``words.mix`` of one integer."""
    value &= _ALL
    value = (value ^ (value >> 30)) * _MIX_1 & _ALL
    value = (value ^ (value >> 27)) * _MIX_2 & _ALL
    return value ^ (value >> 31)


class Dropped:
    """Candidates that are skipped by hash, under a key for each unit."""

    def __init__(self, keys: np.ndarray, dropout: float):
        self.keys, self.dropout, self.any = keys, dropout, dropout > 0

    def of(self, units: np.ndarray) -> Dropped:
        return Dropped(self.keys[units], self.dropout)

    def hold(self, units: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether a place of each of these units is skipped."""
        return skipped(self.keys[units], places, self.dropout)

    def holds(self, place: int) -> bool:
        """The same for one place of one unit."""
        return _mix(int(self.keys[0]) ^ place) < int(limit(self.dropout))


class Without:
    """Candidates that are left out, a row of places for each unit."""

    def __init__(self, places: np.ndarray):
        self.places, self.any = places, places.shape[1] > 0

    def of(self, units: np.ndarray) -> Without:
        return Without(self.places[units])

    def hold(self, units: np.ndarray, places: np.ndarray) -> np.ndarray:
        held = np.zeros(places.shape, dtype=bool)
        for column in self.places.T:
            held |= places == column[units]
        return held

    def holds(self, place: int) -> bool:
        return place in self.places[0].tolist()


def within(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all spans, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(lengths.sum()))


class Encoder:
    """Encodes units of letters; ``steps`` also tells the merges."""

    def __init__(self, vocabulary: Vocabulary, dropout: float):
        self.vocabulary, self.dropout = vocabulary, dropout

    def __call__(self, units: Sequence[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each unit has, under the keys of their occurrences."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        return self.spans(np.frombuffer(b"".join(units), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths, keys)

    def spans(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for units that are parts of ``data``."""
        ids, counts, _ = self._encode(data, starts, lengths, Dropped(keys, self.dropout))
        return ids, counts

    def steps(
        self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, without: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, how many each unit has, the places merged in order, and how many; a row of ``without`` is left out for each unit."""
        ids, counts, merged = self._encode(data, starts, lengths, Without(without))
        own, places_ = (np.concatenate(parts) for parts in zip(*merged)) if merged else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        order = np.argsort(own, kind="stable")
        return ids, counts, places_[order], np.bincount(own, minlength=len(starts))

    def _encode(
        self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, skips: Dropped | Without
    ) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        text = data[within(starts, lengths)]
        before = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])  # letters before each byte
        ends = before[np.cumsum(lengths)]
        sizes = np.diff(ends, prepend=0)
        letters = np.frombuffer(text.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        pieces = self.vocabulary.letter[letters]
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        merged: list[tuple[np.ndarray, np.ndarray]] = []
        group = np.searchsorted(WIDTHS, sizes)
        for at, width in enumerate(WIDTHS):
            wide = np.flatnonzero(group == at)
            for block in range(0, len(wide), BLOCK):
                chosen = wide[block : block + BLOCK]
                own = sizes[chosen]
                rows = np.full((width, len(chosen)), NONE, dtype=np.int64)
                rows[within(np.zeros(len(chosen), np.int64), own), np.repeat(np.arange(len(chosen)), own)] = pieces[within(ends[chosen] - own, own)]
                found, done = self._rounds(rows, skips.of(chosen))
                parts.append((chosen, *self._left(found)))
                merged += [(chosen[units], at_) for units, at_ in done]
        for unit in np.flatnonzero(group == len(WIDTHS)).tolist():
            found, done = self.by_heap(pieces[ends[unit] - sizes[unit] : ends[unit]], skips.of(np.array([unit])))
            parts.append((np.array([unit]), found, np.array([len(found)])))
            merged.append((np.full(len(done), unit), done))
        counts = np.zeros(len(starts), dtype=np.int64)
        for chosen, _, own in parts:
            counts[chosen] = own
        begin = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), dtype=np.int64)
        for chosen, found, own in parts:
            flat[within(begin[chosen], own)] = found
        ids, counts = self.vocabulary.spelled(flat, counts)
        return ids.astype(np.int32), counts, merged

    @staticmethod
    def _left(pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces in all columns, and how many each has."""
        rows = np.ascontiguousarray(pieces.T)
        kept = (rows != GONE) & (rows != NONE)
        return rows[kept], kept.sum(axis=1)

    def _together(self, pieces: np.ndarray, skips: Dropped | Without) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """The pieces of each unit, from a row of letters, and for each round the units and the places merged."""
        found, merged = self._rounds(pieces.T, skips)
        flat, counts = self._left(found)
        return np.split(flat, np.cumsum(counts)[:-1]), merged

    def _rounds(self, letters: np.ndarray, skips: Dropped | Without) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The pieces of units, a column of letters each, where they begin, and for each round the units and the places merged.

        Every column is merged one step a round. A piece knows where it and the one before begin and where it ends, so that
        a step changes the few places beside it only; the best candidate is the least number of a column.
        """
        size, count = letters.shape
        bits = size.bit_length()
        none = np.int64(np.iinfo(np.int64).max)
        # a row without letters before and behind
        piece = np.full((size + 2, count), NONE, dtype=np.int64)
        piece[1:-1] = letters
        piece = piece.ravel()
        row = np.repeat(np.arange(size + 2), count)
        end, before = row + 1, row - 1
        agenda = np.full((size + 2) * count, none)
        made = np.full((size + 2) * count, -1, dtype=np.int64)
        merged: list[tuple[np.ndarray, np.ndarray]] = []

        def propose(units: np.ndarray, left: np.ndarray, right: np.ndarray, begin: np.ndarray, middle: np.ndarray) -> None:
            """Puts what pieces make with the ones behind on the agenda, unless it is skipped."""
            new = self.vocabulary.joined(piece[left], piece[right])
            agenda[left] = none
            able = np.flatnonzero(new >= 0)
            if skips.any and len(able):
                held = skips.hold(units[able], places(begin[able] - 1, middle[able] - 1, end[right[able]] - 1))
                able = able[~held]
            at, new = left[able], new[able]
            made[at] = new
            agenda[at] = (self.vocabulary.rank[new] << bits) | begin[able]

        # letters that make something
        inner = np.flatnonzero(piece[count:-count] >= 0) + count
        propose(inner % count, inner, inner + count, row[inner], row[inner] + 1)
        table = agenda.reshape(size + 2, count)[1:-1]
        while True:
            best = table.min(axis=0)
            units = np.flatnonzero(best != none)
            if not len(units):
                break
            begin = best[units] & ((1 << bits) - 1)
            left = begin * count + units
            middle = end[left]
            right = middle * count + units
            stop = end[right]
            behind = stop * count + units
            merged.append((units, places(begin - 1, middle - 1, stop - 1)))
            piece[left], piece[right] = made[left], GONE
            end[left], before[behind], agenda[right] = stop, begin, none
            first = before[left]
            propose(
                np.concatenate([units, units]),
                np.concatenate([first * count + units, left]),
                np.concatenate([left, behind]),
                np.concatenate([first, begin]),
                np.concatenate([begin, stop]),
            )
        return piece.reshape(size + 2, count)[1:-1], merged

    def by_heap(self, pieces: np.ndarray, skips: Dropped | Without) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of one unit and the places merged, by an agenda of candidate merges in order of score."""
        vocabulary, size = self.vocabulary, len(pieces)
        piece = pieces.tolist()
        end = list(range(1, size + 1))  # of the piece that begins here
        before = list(range(-1, size - 1))
        agenda: list[tuple[float, int, int, int, int]] = []
        merged: list[int] = []

        def propose(left: int, right: int) -> None:
            made = vocabulary.merge.get((piece[left], piece[right]))
            if made is not None:
                heapq.heappush(agenda, (-vocabulary.score[made], left, right, end[right], made))

        for left in range(size - 1):
            propose(left, left + 1)
        gone = [False] * size
        while agenda:
            _, left, right, stop, made = heapq.heappop(agenda)
            if gone[left] or gone[right] or end[left] != right or end[right] != stop:
                continue
            place = _mix((_mix(left * _STEP + right) + stop))
            if skips.any and skips.holds(place):
                continue
            merged.append(place)
            piece[left], end[left], gone[right] = made, stop, True
            if stop < size:
                before[stop] = left
                propose(left, stop)
            if left:
                propose(before[left], left)
        return np.array([piece[at] for at in range(size) if not gone[at]], dtype=np.int64), np.array(merged, dtype=np.uint64)


class DroppedUnits(Units):
    """Pieces of occurrences of units, each under a key of its own.

    ``nodes`` has the hashes of units and the candidates left out of them, sorted, ``entry`` where the pieces and merges of each are.
    """

    def __init__(self, encoder: Encoder, apart: np.ndarray):
        self.encoder = encoder
        super().__init__(encoder, apart)

    def _forget(self) -> None:
        super()._forget()
        self.nodes, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.merge_begin, self.merge_count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.merges = np.zeros(0, np.uint64)

    def _entries(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, nodes: np.ndarray, without: np.ndarray) -> np.ndarray:
        """Where the pieces and merges of units without some candidates are remembered; -1 if it is not worth it.

        A unit without candidates that is met but once here is cheaper encoded by itself.
        """
        distinct, first, place, times = np.unique(nodes, return_index=True, return_inverse=True, return_counts=True)
        found = np.searchsorted(self.nodes, distinct)
        at = np.full(len(distinct), -1, dtype=np.int64)
        inside = np.flatnonzero(found < len(self.nodes))
        inside = inside[self.nodes[found[inside]] == distinct[inside]]
        at[inside] = self.entry[found[inside]]
        missing = np.flatnonzero((at < 0) & ((times > 1) | (without.shape[1] == 0)))
        if len(missing):
            at[missing] = len(self.begin) + np.arange(len(missing))
            self.nodes = np.insert(self.nodes, found[missing], distinct[missing])
            self.entry = np.insert(self.entry, found[missing], at[missing])
            self._learn_merges(data, starts[first[missing]], stops[first[missing]], without[first[missing]])
        return at[place]

    def _learn_merges(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, without: np.ndarray) -> None:
        ids, lengths, merges, counts = self.encoder.steps(data, starts, stops - starts, without)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, ids])
        self.merge_begin = np.concatenate([self.merge_begin, len(self.merges) + np.cumsum(counts) - counts])
        self.merge_count = np.concatenate([self.merge_count, counts])
        self.merges = np.concatenate([self.merges, merges])

    def _ids(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``keys`` has the units' hashes and the occurrences' keys."""
        hashed, own = keys
        if len(self.nodes) > CACHED:
            self._forget()
        entry = np.full(len(hashed), -1, dtype=np.int64)
        left = np.flatnonzero(stops - starts <= LONG)
        nodes, without = hashed[left], np.zeros((len(left), 0), dtype=np.uint64)
        for _ in range(LEVELS):
            at = self._entries(data, starts[left], stops[left], nodes, without)
            entry[left] = at
            kept = np.flatnonzero(at >= 0)
            left, nodes, without, at = left[kept], nodes[kept], without[kept], at[kept]
            counts = self.merge_count[at]
            ends = np.cumsum(counts)
            each = np.repeat(np.arange(len(left)), counts)
            merges = self.merges[np.repeat(self.merge_begin[at] - (ends - counts), counts) + np.arange(len(each))]
            hits = np.flatnonzero(skipped(own[left][each], merges, self.encoder.dropout))
            open_, first = np.unique(each[hits], return_index=True)
            skips = merges[hits[first]]
            left, nodes = left[open_], words.mix(nodes[open_] ^ skips)
            without = np.concatenate([without[open_], skips[:, None]], axis=1)
            entry[left] = -1
            if not len(left):
                break
        alone = np.flatnonzero(entry < 0)
        ids, own_lengths = self.encoder.spans(data, starts[alone], stops[alone] - starts[alone], own[alone])
        flat = np.concatenate([self.flat, ids])
        begin, lengths = self.begin[entry] if len(self.begin) else np.zeros(len(entry), np.int64), np.zeros(len(entry), np.int64)
        lengths[entry >= 0] = self.length[entry[entry >= 0]]
        begin[alone], lengths[alone] = len(self.flat) + np.cumsum(own_lengths) - own_lengths, own_lengths
        ends = np.cumsum(lengths)
        return flat[np.repeat(begin - (ends - lengths), lengths) + np.arange(int(lengths.sum()))], lengths


_vocabularies: dict[str, Vocabulary] = {}
_units: dict[tuple[str, float], Units] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def units(path: str, dropout: float) -> Units:
    """The units that this worker remembers."""
    if (path, dropout) not in _units:
        kind = DroppedUnits if dropout else Units
        _units[path, dropout] = kind(Encoder(vocabulary(path), dropout), vocabulary(path).apart())
    return _units[path, dropout]


def occurrence_keys(documents: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The keys of units at a place in documents with these keys."""
    return words.mix(documents + place.astype(np.uint64) * words.STEP)


def document_keys(ids: pa.Array, seed: int) -> np.ndarray:
    return words.mix(pc.fill_null(ids, NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(seed * 2 + 1))


def encoded(column: pa.Array, ids: pa.Array, path: str, *, dropout: float, seed: int) -> Iterator[np.ndarray]:
    """The pieces of each text."""
    own = document_keys(ids, seed)

    def keyed(begin: int, hashed: np.ndarray, before: np.ndarray, first: int) -> np.ndarray:
        if not dropout:
            return hashed
        counts = np.diff(before)
        place = np.arange(len(hashed)) - np.repeat(before[:-1], counts)
        return np.stack([hashed, occurrence_keys(np.repeat(own[begin + first : begin + first + len(counts)], counts), place)])

    known = units(path, dropout)
    for begin, end in words.slices(column, SLICE):  # texts are copied, so a few at a time
        part = column.slice(begin, end - begin).cast(pa.large_string())
        led = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), part, pa.scalar("", pa.large_string()))
        filled = pc.fill_null(pc.greater(pc.binary_length(part), 0), False)
        yield from known.texts(pc.if_else(filled, led, pa.scalar("", pa.large_string())), lambda *at: keyed(begin, *at))


def _packed_batches(columns: list[pa.Array], values: Iterator[np.ndarray], names: list[str], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows with a binary column, in batches of bounded size."""
    begin, held, size = 0, [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c.slice(begin, len(held)) for c in columns] + [pa.array(held, pa.binary())], names=names)

    for value in values:
        held.append(value.astype("<u4").tobytes())
        size += len(held[-1])
        if size >= limit:
            yield batch()
            begin, held, size = begin + len(held), [], 0
    if held:
        yield batch()


def encode_documents(
    docs: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    model: str | None = None,
    dropout: float = DROPOUT,
    seed: int = SEED,
) -> DataFrame:
    """The other columns as a struct ``doc``, with the pieces' ids as little-endian unsigned 32-bit integers; null for a null text."""
    path = model or public_tokenizers.path(MODEL)
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != text]).alias("doc")
    rows = docs.select(others, F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = encoded(batch.column("text"), batch.column("id"), path, dropout=dropout, seed=seed)
            yield from _packed_batches([batch.column("doc"), pc.is_null(batch.column("text"))], found, ["doc", "none", "ids"])

    doc = docs.select(others).schema["doc"].dataType.simpleString()
    made = in_arrow(rows, pieces, f"doc {doc}, none boolean, ids binary")
    return made.select("doc", F.when(~F.col("none"), F.col("ids")).alias("ids"))


def decode_documents(encoded_docs: DataFrame, *, model: str | None = None) -> DataFrame:
    """``doc`` and ``ids`` with the text."""
    path = model or public_tokenizers.path(MODEL)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                vocabulary(path).decode(np.frombuffer(ids.as_buffer(), dtype="<u4")).decode("utf-8") if ids.is_valid else None
                for ids in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=["doc", "ids", "text"])

    doc = encoded_docs.schema["doc"].dataType.simpleString()
    return in_arrow(encoded_docs.select("doc", "ids"), texts, f"doc {doc}, ids binary, text string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2("text", 256).alias("before"))
    decoded = decode_documents(encode_documents(docs))
    return decoded.select(
        "doc.doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("text_sha256"),
        (F.sha2("text", 256) == F.col("doc.before")).alias("lossless"),
    )
