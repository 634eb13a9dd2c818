"""Line de-duplication by winnowing: runs of lines that an earlier document holds are deleted from later ones.

A gram is the shortest run of lines from a given line on that has ``GRAM_WORDS`` words, and its hash is that
of those lines. Of all grams within the shortest run of lines that has ``RUN_WORDS`` words, the one of least hash
(the last of equals) is a fingerprint. Every run of lines of ``RUN_WORDS`` words therefore holds a
fingerprint, and a repeated run holds the same one wherever it stands, which is what makes the fingerprints
guaranteed though they are few.

Fingerprints are joined with the place where each occurs first, not with each other, so a passage that many
documents share makes as many matches as it has occurrences. Each match is extended line by line both ways,
and the run it grows to is deleted from the later place. So each deleted line also stands in an earlier
document (or earlier in the same one), and of a run of repeated lines fewer than ``RUN_WORDS`` words in a row
can stay. Runs of less than ``GRAM_WORDS`` words, such as a license line, are never deleted.

Documents are ordered by id, then by reading order; a null id comes last. Lines are equal when the same after blanks at
both ends are cut off; lines of blanks alone are not compared and stay. Defined results: null text stays null with no
lines, an empty text has none; repeated rows are later documents like others. Rows are
written once with their numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import words
from cartwheel.llm.tables import ROW_IDS, in_arrow, numbered, saved, table

GRAM_WORDS = 25
RUN_WORDS = 50

_NEWLINE = words.separators(b"\n")
_BLANK = words.separators(words.BLANKS)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and words of each line that is not blank, without blanks at its ends, and the lines before each text."""
    begins, ends, _ = words.spans(data, offsets, _BLANK)
    starts, stops, _ = words.spans(data, offsets, _NEWLINE)
    first = np.searchsorted(begins, starts)
    last = np.searchsorted(begins, stops)
    held = last > first
    first, last = first[held], last[held]
    starts, stops = begins[first], ends[last - 1]
    return starts, stops, last - first, np.searchsorted(starts, offsets)


def fingerprints(lines: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of one text, from its lines' hashes and words."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.concatenate([[0], np.cumsum(counts)])
    if total[-1] < GRAM_WORDS:
        return none
    # the line behind the shortest run from each line that has so many words
    gram_end = np.searchsorted(total, total[:-1] + GRAM_WORDS)
    run_end = np.searchsorted(total, total[:-1] + RUN_WORDS)
    grams = int(np.searchsorted(gram_end, len(lines), side="right"))
    hashed = np.zeros(grams, dtype=np.uint64)
    size = gram_end[:grams] - np.arange(grams)
    value, left = size.astype(np.uint64), np.arange(grams)
    step = 0
    while len(left):
        value[left] = words.mix(value[left] * words.STEP + lines[left + step])
        step += 1
        left = left[size[left] > step]
    hashed[:] = value
    runs = int(np.searchsorted(run_end, len(lines), side="right"))
    chosen = []
    for line in range(runs):
        # grams that end within the run
        last = int(np.searchsorted(gram_end, run_end[line], side="right"))
        within = hashed[line : min(last, grams)]
        chosen.append(line + len(within) - 1 - int(np.argmin(within[::-1])))
    places = np.unique(np.array(chosen, dtype=np.int64))
    return places, hashed[places]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "doc_id", "n_lines", "lines", "places", "hashes"]
    for batch in batches:
        column = batch.column("text")
        for begin, end in words.slices(column):
            data, offsets = words.text_bytes(column.slice(begin, end - begin))
            starts, stops, counts, before = lines_of(data, offsets)
            hashed = words.hashes(data, starts, stops, fold=False)
            out: list[list] = [[], [], [], []]
            for row in range(end - begin):
                own, own_counts = hashed[before[row] : before[row + 1]], counts[before[row] : before[row + 1]]
                places, found = fingerprints(own, own_counts)
                values = len(own), own.tobytes(), places, found.view(np.int64)
                for column_, value in zip(out, values):
                    column_.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(begin, end - begin),
                    batch.column("doc_id").slice(begin, end - begin),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.binary()),
                    pa.array(out[2], pa.list_(pa.int64())),
                    pa.array(out[3], pa.list_(pa.int64())),
                ],
                names=names,
            )


def extended(own: np.ndarray, other: np.ndarray, shift: int, places: list[int]) -> list[tuple[int, int]]:
    """The runs around ``places`` in which ``own`` at a place is ``other`` at the place plus ``shift``."""
    low, high = max(0, -shift), min(len(own), len(other) - shift)
    same = own[low:high] == other[low + shift : high + shift]
    breaks = np.flatnonzero(~same) + low
    runs = set()
    for place in places:
        at = int(np.searchsorted(breaks, place))
        runs.add((int(breaks[at - 1]) + 1 if at else low, int(breaks[at]) if at < len(breaks) else high))
    return sorted(runs)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, begins, ends = [], [], []
        for row, shift, skipped, places, lines, first in zip(*(batch.column(k) for k in range(6))):
            own = np.frombuffer(lines.as_buffer(), dtype=np.uint64)
            other = np.frombuffer(first.as_buffer(), dtype=np.uint64)
            for begin, end in extended(own, other, shift.as_py() - skipped.as_py(), places.as_py()):
                rows.append(row.as_py())
                begins.append(begin)
                ends.append(end)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], names=["row", "begin", "end"]
        )


def without_lines(text: str, runs: list[dict]) -> tuple[str, int, int]:
    """The text without the runs of its lines that are not blank, and the number of lines and words left out."""
    gone = {line for run in runs for line in range(run["begin"], run["end"])}
    kept, number, lost = [], -1, 0
    blanks = words.BLANKS.decode()
    for line in text.split("\n"):
        if line.strip(blanks):
            number += 1
            if number in gone:
                lost += len(_WORD.findall(line))
                continue
        kept.append(line)
    return "\n".join(kept), len(gone), lost


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text, runs in zip(batch.column("text"), batch.column("runs")):
            found.append(without_lines(text.as_py(), runs.as_py()) if runs.is_valid else (text.as_py(), 0, 0))
        texts, lines, lost = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64())],
            names=["doc", "text", "n_removed", "words_removed"],
        )


def dedup_lines(docs: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` but the text as a struct ``doc``, with the text that is left, n_removed and words_removed."""
    others = [F.col(f"`{name}`") for name in docs.columns if name != text]
    rows = numbered(
        docs.select(
            F.col(f"`{id}`").cast("bigint").alias("doc_id"),
            F.col(f"`{text}`").cast("string").alias("text"),
            F.struct(*others).alias("doc"),
        ),
        "numbered",
    )
    described = "row bigint, doc_id bigint, n_lines bigint, lines binary, places array<bigint>, hashes array<bigint>"
    lines = saved(in_arrow(rows.select("row", "doc_id", "text"), _described, described), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row", "place")
    prints = lines.select("row", "doc_id", F.explode(F.arrays_zip("places", "hashes")).alias("print")).select(
        "row", F.col("print.hashes").alias("hash"), F.col("print.places").alias("place"), "doc_id"
    )
    first = prints.groupBy("hash").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
    matches = (
        prints.join(first.select("hash", F.col("first.row").alias("first_row"), F.col("first.place").alias("first_place")), "hash")
        .where("row <> first_row or place <> first_place")
        .groupBy("row", "first_row", (F.col("first_place") - F.col("place")).alias("shift"))
        .agg(F.collect_list("place").alias("places"))  # of one document
    )
    own = lines.select("row", "n_lines", "lines")
    other = lines.select(F.col("row").alias("first_row"), F.col("lines").alias("first_lines"))
    # of the earlier document, only the stretch that can lie beside the later one
    skipped = F.greatest(F.col("shift"), F.lit(0))
    stretch = F.substring("first_lines", (8 * skipped + 1).cast("int"), (8 * F.col("n_lines")).cast("int"))
    pairs = (
        matches.join(own, "row")
        .join(other, "first_row")
        .select("row", "shift", skipped.alias("skipped"), "places", "lines", stretch.alias("first_lines"))
    )
    runs = saved(
        in_arrow(pairs, _extended, "row bigint, begin bigint, end bigint")
        .groupBy("row")
        .agg(F.collect_set(F.struct("begin", "end")).alias("runs")),
        "runs",
    )
    number = runs.agg(F.sum(F.size("runs") + 1)).first()[0] or 0
    # two numbers a run; beyond that Spark joins both sides
    whole = rows.join(F.broadcast(runs) if number <= ROW_IDS // 8 else runs, "row", "left").select("doc", "text", "runs")
    doc = docs.select(F.struct(*others).alias("doc")).schema["doc"].dataType.simpleString()
    return in_arrow(whole, _cleaned, f"doc {doc}, text string, n_removed bigint, words_removed bigint")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc.doc_id",
        "n_removed",
        "words_removed",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.sha2("text", 256).alias("text_sha256"),
    )
