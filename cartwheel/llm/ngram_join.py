"""Similarity join of documents on word 5-shingles (Jaccard) under several global token orders.

Two sets whose Jaccard similarity is at least T share a token among the first ``n - ceil(T n) + 1`` of each,
under any order of all tokens. Filters of several orders are intersected before a pair is verified:

1. The first order takes the tokens below a fixed share of the hash space, rarest first (rarity counted
   over all documents), then all others by hash. The prefixes lie in that share, so only it is counted and
   joined. Tokens of one document have no partner; a document whose prefix holds no shared token is done.
   Passages shared by many documents are frequent, so they come late and seldom enter a prefix.
2. The second order takes all tokens of the documents that are left, rarest first among these. Its
   prefixes make the candidates. The tokens that a document holds alone also bound what it can share.
3. Two further orders are keyed hashes; a pair must meet in the prefix of each as well.
4. What is left is verified exactly, on the whole sets.

No group is paired with itself row by row. Equal sets are one class from the start. Then each prefix token
links its documents to one pivot only, each document is verified against the pivot that it shares most tokens
with, and the links found are merged. That pivot also names the document's cluster. Documents that share a
prefix token and still lie in different components may be linked, too: those outside a token's commonest component are
attached to the clusters of its other documents, and blocks of attached documents meet blocks of
cluster members. A block intersects the filters of all orders, verifies and hands on one link for each component
met. So every candidate pair in different components is verified, while the rows grow with the number of blocks.

Defined results: null text counts as empty; empty documents have no shingle, link with nothing and are
their own component; fewer words than a shingle make one shingle. A null id takes no part in naming a
component; a component of null ids alone is null. Repeated rows are equal sets. Shingles are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import words
from cartwheel.llm.components import components
from cartwheel.llm.tables import in_arrow, numbered, rows_in, saved, ship, small_batches, table

SHINGLE = 5
THRESHOLD = (75, 100)  # least intersection / union
BLOCK = 256  # sets on either side of a group of comparisons
SHARE = 0.4  # of the hash space, which the first order puts first; over 1 - T
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)  # keys of the further orders
_LIMIT = np.uint64(int(SHARE * 2**64))


def prefix_size(size: int) -> int:
    part, whole = THRESHOLD
    return size - -(-part * size // whole) + 1


def first_tokens(shingles: np.ndarray) -> np.ndarray:
    """The tokens among which a set's prefix under the first order lies."""
    tokens = np.sort(words.mix(shingles))
    return tokens[: max(int(np.searchsorted(tokens, _LIMIT)), prefix_size(len(tokens)))]


def order_prefix(shingles: np.ndarray, key: int) -> np.ndarray:
    """The sorted prefix under a keyed hash order."""
    count = prefix_size(len(shingles))
    ranked = words.mix(shingles ^ np.uint64(key))
    return np.sort(np.partition(ranked, count - 1)[:count]) if len(ranked) > count else np.sort(ranked)


def linked(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    part, whole = THRESHOLD
    return whole * common >= part * (len(left) + len(right) - common)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of row, doc_id, text: size, number of first tokens and signature of each set."""
    for batch in batches:
        sizes, firsts, signatures = [], [], []
        for shingles in words.shingle_sets(batch.column("text"), SHINGLE):
            sizes.append(len(shingles))
            firsts.append(len(first_tokens(shingles)) if len(shingles) else 0)
            signatures.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(firsts, pa.int64()),
                pa.array(signatures, pa.binary()),
            ],
            names=["row", "doc_id", "n", "m", "signature"],
        )


def _first_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        firsts = [
            first_tokens(shingles).view(np.int64) if len(shingles) else np.zeros(0, np.int64)
            for shingles in words.shingle_sets(batch.column("text"), SHINGLE)
        ]
        yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(firsts)], names=["row", "tokens"])


def _all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles.view(np.int64) for shingles in words.shingle_sets(batch.column("text"), SHINGLE)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(sets)], names=["row", "tokens"])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(own) for own in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [shingles.tobytes() for shingles in words.shingle_sets(batch.column("text"), SHINGLE)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(packed, pa.binary())], names=["row", "shingles"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that meet in the prefix of every further order and are similar enough."""
    for batch in batches:
        keep = []
        for row, (left, right) in enumerate(zip(batch.column("left"), batch.column("right"))):
            mine = np.frombuffer(left.as_buffer(), dtype=np.uint64)
            other = np.frombuffer(right.as_buffer(), dtype=np.uint64)
            meet = all(
                len(np.intersect1d(order_prefix(mine, key), order_prefix(other, key), assume_unique=True))
                for key in ORDERS
            )
            if meet and linked(mine, other):
                keep.append(row)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set on the left, the sizes of its intersections with all sets on the right."""
    tokens = np.concatenate([np.zeros(0, np.uint64), *right])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], np.repeat(np.arange(len(right)), [len(own) for own in right])[order]
    for own in left:
        begin = np.searchsorted(tokens, own, side="left")
        count = np.searchsorted(tokens, own, side="right") - begin
        shift = np.repeat(begin - (np.cumsum(count) - count), count)
        yield np.bincount(owner[shift + np.arange(len(shift))], minlength=len(right))


def _block_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links of the rows on the left with rows on the right in other components, one for each component met."""
    found: list[tuple[int, int]] = []
    columns = left["shingles"], right["other_shingles"]
    mine, other = ([np.frombuffer(own.as_buffer(), dtype=np.uint64) for own in column] for column in columns)
    if mine and other:
        rows, others = left["row"].to_numpy(), right["other_row"].to_numpy()
        labels = right["other_label"].to_numpy()
        sizes = np.array([len(own) for own in other])
        part, whole = THRESHOLD
        meets = [overlaps([order_prefix(s, key) for s in mine], [order_prefix(s, key) for s in other]) for key in ORDERS]
        for at, (label, common, *met) in enumerate(zip(left["label"].to_numpy(), overlaps(mine, other), *meets)):
            candidates = (labels != label) & np.logical_and.reduce([shared > 0 for shared in met])
            similar = candidates & (whole * common >= part * (len(mine[at]) + sizes - common))
            _, first = np.unique(labels[similar], return_index=True)
            found += [(int(rows[at]), int(b)) for b in others[similar][first]]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


class SimilarDocuments:
    """Components of ``docs``, whose rows are written once with their numbers."""

    def __init__(self, docs: DataFrame, *, text: str = "text", id: str = "doc_id"):
        self.docs = docs
        doc = F.col("doc")
        self.whole = numbered(docs.select(F.struct("*").alias("doc")), "numbered")
        self.texts = self.whole.select(
            "row", doc.getField(id).cast("bigint").alias("doc_id"), doc.getField(text).cast("string").alias("text")
        )
        self.sets = saved(
            in_arrow(self.texts, _described, "row bigint, doc_id bigint, n bigint, m bigint, signature binary"), "sets"
        )
        classes = self.sets.where("n > 0").groupBy("signature").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies"))
        classes = saved(classes.where("copies > 1"), "classes")  # written, so that a class of many copies can be split in the join
        self.copies = saved(self.sets.join(classes, "signature").where("row <> first").select("row", "first"), "copies")
        self.prefixes = saved(self._prefixes(), "prefixes")
        self.links = self._linked()

    def _prefixes(self) -> DataFrame:
        """(row, n, slack, token) for the shared tokens in the prefixes of classes of equal sets, under the two orders by rarity.

        A set that holds no shared token in its prefix under the first order is left out of the second.
        """
        distinct = rows_in(self.texts.select("row", "text"), self.copies.select("row"), keep=False)
        first = in_arrow(distinct, _first_tokens, "row bigint, tokens array<bigint>")
        limit = F.lit(int(_LIMIT) - (1 << 64) if int(_LIMIT) >> 63 else int(_LIMIT))
        late = (F.col("token") < 0) | (F.col("token") >= limit)
        left = saved(self._shared(first, "m", late).select("row"), "left")
        whole = rows_in(self.texts.select("row", "text"), left, keep=True)
        return self._shared(in_arrow(whole, _all_tokens, "row bigint, tokens array<bigint>"), "n", F.lit(False)).select(
            "row", "n", "slack", F.explode("prefix").alias("token")
        )

    def _shared(self, sets: DataFrame, size: str, late: Column) -> DataFrame:
        """Rows with shared tokens in their prefix, rarest first and the ``late`` ones last; ``size`` names the number of tokens given."""
        tokens = sets.select("row", F.explode("tokens").alias("token"))
        shared = saved(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1"), "shared")
        place = F.struct(late.alias("late"), F.when(late, 0).otherwise(F.col("docs")).alias("docs"), "token")
        found = (
            tokens.join(shared.hint("shuffle_hash"), "token")
            .groupBy("row")
            .agg(F.array_sort(F.collect_list(place)).alias("shared"))  # of one document's own tokens
        )
        part, whole = THRESHOLD
        prefix = F.col("n") - F.ceil(F.col("n") * part / whole) + 1
        alone = F.col(size) - F.size("shared")
        return (
            found.join(self.sets.select("row", "n", "m"), "row")
            .withColumn("left", (prefix - alone).cast("int"))
            .where("left > 0")
            .withColumn("slack", (whole + part) * alone - (whole - part) * F.col("n"))
            .select("row", "n", "slack", F.transform(F.slice("shared", F.lit(1), F.greatest(F.col("left"), F.lit(0))), lambda p: p["token"]).alias("prefix"))
        )

    @staticmethod
    def _allowed(n: Column, other_n: Column, slack: Column, other_slack: Column) -> Column:
        """Whether sets of these sizes may be linked, none of whose tokens of one document alone are common."""
        part, whole = THRESHOLD
        return (whole * F.least(n, other_n) >= part * F.greatest(n, other_n)) & (slack + other_slack <= 0)

    def _pivot_pairs(self) -> DataFrame:
        """Each row with the pivot that it shares most prefix tokens with.

        The pivot of a token is, among rows of about one size, the one with the fewest tokens of its own.
        """
        part, whole = THRESHOLD
        band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(whole / part)))
        rows = self.prefixes.withColumn("band", band)
        pivots = rows.groupBy("token", "band").agg(F.min(F.struct("slack", "row", "n")).alias("pivot"), F.count(F.lit(1)).alias("rows"))
        pivot = F.col("pivot")
        return (
            rows.join(pivots.where("rows > 1"), ["token", "band"])
            .where((F.col("row") != pivot["row"]) & self._allowed(F.col("n"), pivot["n"], F.col("slack"), pivot["slack"]))
            .groupBy("row", pivot["row"].alias("pivot"))
            .agg(F.count(F.lit(1)).alias("votes"))
            .groupBy("row")
            .agg(F.max_by("pivot", F.struct("votes", -F.col("pivot"))).alias("pivot"))
            .select(F.col("pivot").alias("a"), F.col("row").alias("b"))
        )

    def _attached(self, rows: DataFrame) -> DataFrame:
        """(row, cluster): rows that share a prefix token with a row of the cluster that lies in another component.

        Of each token, only the rows outside its commonest component are attached, to the clusters of all
        its rows, so that of two rows in different components one at least is attached to the other's cluster.
        """
        per_label = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("rows"))
        commonest = per_label.groupBy("token").agg(
            F.max(F.struct("rows", "label")).getField("label").alias("common"), F.count(F.lit(1)).alias("labels")
        )
        crossing = rows.join(commonest.where("labels > 1"), "token")
        part, whole = THRESHOLD
        clusters = crossing.groupBy("token", "cluster").agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min("n").alias("least_n"),
            F.max("n").alias("most_n"),
            F.min("slack").alias("least_slack"),
        )
        return (
            crossing.where("label <> common")
            .select("token", "row", "label", "n", "slack")
            .join(clusters, "token")
            .where("(low <> label or high <> label) and slack + least_slack <= 0")
            .where((whole * F.col("most_n") >= part * F.col("n")) & (whole * F.col("n") >= part * F.col("least_n")))
            .select("row", "cluster")
            .distinct()
        )

    def _crossing_links(self, pairs: DataFrame, links: DataFrame) -> DataFrame:
        """Links between rows of different components, from blocks of attached rows and cluster members."""
        # each row hangs on one pivot, so these are trees; a family of near copies makes a few of them at most
        cluster = components(pairs).select(F.col("a").alias("row"), F.col("b").alias("cluster"))
        label = links.select(F.col("a").alias("row"), F.col("b").alias("label"))
        known = (
            self.prefixes.select("row")
            .distinct()
            .join(cluster, "row", "left")
            .join(label, "row", "left")
            .select("row", F.coalesce("cluster", "row").alias("cluster"), F.coalesce("label", "row").alias("label"))
        )
        known = saved(known, "clusters")
        attached = saved(self._attached(saved(self.prefixes.join(known, "row"), "labelled")), "attached")
        of_attached = attached.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("attached_blocks"))
        of_members = known.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("member_blocks"))
        sizes = saved(of_attached.join(of_members, "cluster"), "cluster-sizes")
        members = known.join(sizes, "cluster").select(
            "row",
            "label",
            "cluster",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("attached_blocks") - 1)).alias("i"),
            F.pmod(F.xxhash64("row"), "member_blocks").alias("j"),
        )
        attached = attached.join(sizes, "cluster").join(known.select("row", "label"), "row").select(
            "row",
            "label",
            "cluster",
            F.pmod(F.xxhash64("row"), "attached_blocks").alias("i"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("member_blocks") - 1)).alias("j"),
        )
        shingles = self._shingles(members.select("row").unionByName(attached.select("row")).distinct())
        ship(self.docs.sparkSession)
        names = ["cluster", "i", "j", "row", "label", "shingles"]
        left = attached.join(shingles, "row").select(names)
        right = members.join(shingles, "row").select(*[F.col(name).alias(f"other_{name}") for name in names])
        return (
            left.groupBy("cluster", "i", "j")
            .cogroup(right.groupBy("other_cluster", "other_i", "other_j"))
            .applyInArrow(_block_links, "a bigint, b bigint")
        )

    def _shingles(self, wanted: DataFrame) -> DataFrame:
        texts = rows_in(self.texts.select("row", "text"), saved(wanted, "wanted"), keep=True)
        return saved(in_arrow(texts, _whole_sets, "row bigint, shingles binary"), "shingles")

    def _linked(self) -> DataFrame:
        """(a, b): each row linked to a smaller one, with the smallest row of its component."""
        pairs = saved(self._pivot_pairs(), "pairs")
        shingles = self._shingles(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct())
        left = shingles.select(F.col("row").alias("a"), F.col("shingles").alias("left"))
        right = shingles.select(F.col("row").alias("b"), F.col("shingles").alias("right"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        links = components(in_arrow(both, _similar, "a bigint, b bigint"))
        return components(links.unionByName(self._crossing_links(pairs, links)))

    def rows(self) -> DataFrame:
        """row, doc_id, n, root: the row number of the first row of each document's component."""
        first = self.sets.select("row", "doc_id", "n").join(self.copies, "row", "left")
        label = self.links.select(F.col("a").alias("first"), F.col("b").alias("root"))
        return (
            first.withColumn("first", F.coalesce("first", "row"))
            .join(label, "first", "left")
            .select("row", "doc_id", "n", F.coalesce("root", "first").alias("root"))
        )

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id for each document."""
        rows = self.rows()
        named = saved(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "named")
        return rows.join(named, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")

    def one_each(self) -> DataFrame:
        """The documents, with all their columns, of smallest id in their component."""
        rows = self.rows()
        order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")
        stay = saved(rows.groupBy("root").agg(F.min(order).getField("row").alias("stay")), "stay")
        dropped = saved(rows.join(stay, "root").where("row <> stay").select("row"), "dropped")
        return rows_in(self.whole, dropped, keep=False).select("doc.*")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SimilarDocuments(table(spark, sf_dir, "documents").select("doc_id", "text")).components()


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component."""
    small_batches(spark)
    return SimilarDocuments(docs).one_each()
