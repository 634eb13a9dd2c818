"""Connected components of a graph given by its links, by alternating stars.

Each round hangs the neighbours of a node onto the smallest of them: first those above the node, then
those below. The number of links never grows, and after a few rounds every node hangs on the smallest
node of its component. All steps are joins and minimums over links, so a node of any degree is split
like any other key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.tables import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    above = both.where("b > a").join(least, "a")
    return above.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _falling(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) for each linked node a that is not the smallest of its component, and that smallest node b."""
    links = saved(_falling(links), "links")
    state = None
    while True:
        size = links.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(size) == state or not size[0]:
            return links
        state = tuple(size)
        links = saved(_falling(_small_star(_falling(_large_star(links)))), "links")
