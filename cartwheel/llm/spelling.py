"""Spelling variants of the corpus's words, grouped by a variable-length gram index.

A word's grams have ``SHORTEST`` to ``LONGEST`` letters. The gram dictionary is pruned by frequency: a gram is
replaced by those one letter longer while more than ``threshold`` places of the vocabulary hold it, so rare grams
stay short and common ones grow until they tell words apart. Only the grams that are common have to be known:
a place of a word carries the shortest gram that is not, and places whose gram lies within another one's are left out.

One edit affects few grams. For each place of an edit, those that may differ afterwards are the grams
holding the place, those before it that a changed letter may extend (the letters up to the edit are
a common gram, which the dictionary extends), and those behind it that a changed gram may swallow (the letters from the edit on end
a gram of the dictionary). The most over all places is the word's bound. Two near words share all grams but at most
either one's bound: the first ones up to the edit, and the last ones behind it.

The lists of several grams are therefore merged at once. A word with ``need`` grams more than its bound shares, for some k, its first k and
its last need - k grams with any near word, and all letters before and behind them. For every k it is entered in the list of these
letters, where any near word is as well. ``need`` is at most ``AT_ONCE``; a word with fewer grams above its bound is entered in the lists of fewer grams too,
down to its own number, as a near word of that kind may have no more. A word with no more grams than its bound may share none
with another such word; those are joined by their halves. Of the entries of a list, pairs are dropped whose lengths, letters or
neighbouring letters differ by more than one edit can change, which bit counts tell; the rest is verified by edit distance.

Lists are joined, not collected: their entries are rows of a Spark join that splits a long list. Common grams number at
most ``COMMON`` for each length, whatever the corpus, as each holds more than that share of all places; they
are all that reaches the driver.

From a word the variants lead to its near word with the largest count, if that is ``RATIO`` times its own; as counts
grow by that factor, a chain of them is short and its end is found by doubling.

Defined results: null texts have no words; a null id is written as nothing; words are compared by code points; of
near words with equal counts the first in code-point order is the form. Each row counts, repeated ones as well. Other
columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import in_arrow, saved, table

RUN = "[A-Za-zÀ-ÿ]"
LETTERS = 6  # code points of a word, at least
OCCURRENCES = 5  # of a word, at least
ONE_IN = 199  # of the occurrences is changed
RATIO = 5  # between the counts of a form and its variant, at least

SHORTEST, LONGEST = 2, 3  # letters of a gram
AT_ONCE = 6  # grams whose lists are merged, at most
COMMON = 20_000  # common grams of one length, at most
RARE = 8  # places that hold a gram of the dictionary that is not extended, at least
BITS = 63  # of a word's letters and neighbouring letters
BEGIN, END = "\x02", "\x03"  # around a word, so that its ends have grams of their own

ENTRIES = "word string, n bigint, letters int, odd_letters bigint, odd_pairs bigint, side string, shared string"


def changed_words(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The runs of letters of all texts, A-Z lower-cased; in about one of ``ONE_IN`` a letter is deleted."""
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{LETTERS},}}"), F.lit(0))).alias("run"),
    )
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    lowered = runs.select(
        "key", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, upper.lower())).otherwise(F.col("run")).alias("run")
    )
    hashed = lowered.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run")))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    return hashed.select(F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))


def frequent_words(words: DataFrame) -> DataFrame:
    """The words that are long and frequent enough, with their counts."""
    return (
        words.where(F.length("word") >= LETTERS)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= OCCURRENCES)
    )


@dataclass(frozen=True)
class GramIndex:
    """The common grams, which the dictionary extends."""

    common: frozenset[str]
    tails: frozenset[str]  # ends of the common grams that are extended, without their first letters

    @classmethod
    def of(cls, common: Iterable[str]) -> GramIndex:
        common = frozenset(common)
        return cls(common, frozenset(gram[at:] for gram in common for at in range(1, len(gram))))

    def grams(self, word: str) -> list[tuple[int, int]]:
        """Begin and end of the word's grams; none lies within another."""
        found, reach, common, size = [], 0, self.common, len(word)
        for begin in range(size - SHORTEST + 1):
            end = begin + SHORTEST
            while end < size and end - begin < LONGEST and word[begin:end] in common:
                end += 1
            if end > reach:
                found.append((begin, end))
                reach = end
        return found

    def bound(self, word: str, grams: list[tuple[int, int]]) -> int:
        """How many of the word's grams one edit can affect, at most. Its first and last letter stand for its ends."""
        size, most = len(word), 0
        for edit in range(1, size):
            extended = self._extended(word, edit)
            for behind in (edit, edit + 1) if edit < size - 1 else (edit,):  # an insertion before the letter, a change of it
                swallowed = behind + self._swallowed(word, behind)
                hit = 0
                for begin, end in grams:
                    if begin >= behind:
                        hit += end <= swallowed
                    else:
                        hit += end > edit or begin >= extended
                most = max(most, hit)
        return most

    def _extended(self, word: str, edit: int) -> int:
        """The first place from which a changed letter at ``edit`` may extend a gram."""
        for begin in range(max(edit - LONGEST + 1, 0), edit - SHORTEST + 1):
            if word[begin:edit] in self.common:
                return begin
        return edit

    def _swallowed(self, word: str, begin: int) -> int:
        """How many letters from ``begin`` on may belong to a gram that begins before."""
        for letters in range(min(LONGEST - 1, len(word) - begin), SHORTEST - 1, -1):
            if word[begin : begin + letters - 1] in self.tails:
                return letters
        return 0


def common_grams(words: DataFrame) -> list[str]:
    """The grams held by more places than the threshold, which at most ``COMMON`` of each length can be."""
    framed = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("word"))
    (places,) = framed.agg(F.coalesce(F.sum(F.length("word") - (SHORTEST - 1)), F.lit(0))).first()
    grams = [
        F.transform(F.sequence(F.lit(1), F.length("word") - (size - 1)), lambda at, size=size: F.substr("word", at, F.lit(size)))
        for size in range(SHORTEST, LONGEST)
    ]
    counted = framed.select(F.explode(F.concat(*grams)).alias("gram")).groupBy("gram").agg(F.count("*").alias("places"))
    return [gram for gram, _ in counted.where(F.col("places") > max(RARE, places / COMMON)).collect()]


def _entries(index: GramIndex, word: str) -> Iterator[tuple[str, str]]:
    """The lists of a word: by some of its first and last grams with all letters before and behind, or by its halves."""
    framed = f"{BEGIN}{word}{END}"
    grams = index.grams(framed)
    surplus = len(grams) - index.bound(framed, grams)
    for need in range(max(min(surplus, AT_ONCE), 1), min(AT_ONCE, len(grams)) + 1):
        for first in range(need + 1):
            before = framed[: grams[first - 1][1]] if first else ""
            behind = framed[grams[first - need][0] :] if first < need else ""
            yield f"{first} of {need} grams", f"{before}{END}{behind}"
    if surplus < 1:
        for shorter in (len(word), len(word) - 1):  # of the two words; halves are those of the shorter one
            half = shorter // 2
            yield f"first half of {shorter}", word[:half]
            yield f"last half of {shorter}", word[len(word) - half :]


def odd_letters(word: str) -> int:
    """A bit for every place in a table of letters that an odd number of the word's letters fall on; an edit turns two at most."""
    bits = 0
    for letter in word:
        bits ^= 1 << ord(letter) % BITS
    return bits


def odd_pairs(word: str) -> int:
    """The same of neighbouring letters; an edit turns four at most."""
    bits = 0
    for before, letter in zip(word, word[1:]):
        bits ^= 1 << (31 * ord(before) + ord(letter)) % BITS
    return bits


def list_entries(words: DataFrame) -> DataFrame:
    """A row for each list that a word is in. Lists are numbered by a hash; should two fall together, verifying tells them apart."""
    context = words.sparkSession.sparkContext
    common = context.broadcast(common_grams(words))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GramIndex.of(common.value)
        for batch in batches:
            for begin in range(0, len(batch), 4096):
                part = batch.slice(begin, 4096)
                rows = [
                    (*known, side, shared)
                    for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist())
                    for known in [(word, n, len(word), odd_letters(word), odd_pairs(f"{BEGIN}{word}{END}"))]
                    for side, shared in _entries(index, word)
                ]
                columns = zip(*rows) if rows else [[]] * 7
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(column), kind) for column, kind in zip(columns, kinds)],
                    names=["word", "n", "letters", "odd_letters", "odd_pairs", "side", "shared"],
                )

    listed = in_arrow(words.select("word", "n"), entries, ENTRIES)
    return listed.select(F.xxhash64("side", "shared").alias("list"), "word", "n", "letters", "odd_letters", "odd_pairs")


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of words at one edit from each other, once: word, n, other, other_n."""
    entries = saved(list_entries(words), "gram-lists")
    left, right = entries.alias("left"), entries.alias("right")

    def turned(bits: str) -> Column:
        return F.bit_count(F.col(f"left.{bits}").bitwiseXOR(F.col(f"right.{bits}")))

    near = (
        (F.col("left.list") == F.col("right.list"))
        & (F.abs(F.col("left.letters") - F.col("right.letters")) <= 1)
        & (turned("odd_letters") <= 2)
        & (turned("odd_pairs") <= 4)
        & (F.col("left.word") < F.col("right.word"))
        & (F.levenshtein(F.col("left.word"), F.col("right.word"), 1) == 1)
    )
    pairs = left.join(right, near).select(
        "left.word", "left.n", F.col("right.word").alias("other"), F.col("right.n").alias("other_n")
    )
    return pairs.dropDuplicates(["word", "other"])


def _ends(links: DataFrame, largest: int) -> DataFrame:
    """Each word's last form; a link's count is at least ``RATIO`` times that before, which bounds the chain."""
    ends = links
    for _ in range(math.ceil(math.log2(max(math.log(max(largest, 1), RATIO), 1))) + 1):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = ends.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        ends = saved(step, "roots")
    return ends


def variant_groups(words: DataFrame) -> DataFrame:
    """Distinct ``words`` with counts ``n``: their forms, the ends of the chains of forms, and how many near words they have."""
    words = saved(words.select("word", "n"), "words")
    pairs = saved(near_pairs(words), "near-words")
    turned = pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    best = F.min(F.struct((-F.col("other_n")).alias("fewest"), "other"))
    near = (
        pairs.unionByName(turned)
        .groupBy("word", "n")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", "best.other", (-F.col("best.fewest")).alias("other_n"))
    )
    is_form = F.col("other_n") >= RATIO * F.col("n")
    near = saved(
        near.select("word", "n_near", F.when(is_form, F.col("other")).alias("form"), F.when(is_form, F.col("other_n")).alias("form_n")),
        "forms",
    )
    links = near.where("form IS NOT NULL")
    (largest,) = links.agg(F.coalesce(F.max("form_n"), F.lit(1))).first()
    roots = _ends(links.select("word", F.col("form").alias("root")), largest)
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n",
        )
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(frequent_words(changed_words(table(spark, sf_dir, "documents"))))
