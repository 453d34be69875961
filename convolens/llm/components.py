"""Connected components of a distributed link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import attach, discard, materialise


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.a", "x.b")


def _hung(links: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """Every link a, b of `links` with the least node that `nodes` has for a. No hot node is gathered in one task."""
    return attach(links, nodes, "a", total, "n")


def _least(links: DataFrame) -> DataFrame:
    """For every node of the first column the smallest of itself and its neighbours, and its number of neighbours."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"), F.count(F.lit(1)).alias("n"))


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node that has a link.

    links: a, b of one orderable type. A large-star step hangs all larger neighbours of a node onto its least
    neighbour, a small-star step hangs the smaller ones and the node itself there; both keep components whole and
    the number of links at most the same. It ends when every link points from a node to a root, after about the
    logarithm of the number of nodes in rounds. Every round is written to the shared folder, the tables of the round
    before are removed, and no link is collected.
    """
    links = materialise(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        total = links.count()
        both = _both(links)
        near = materialise(_least(both), "large-least")
        large = _hung(both.where("b > a"), near, 2 * total).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = materialise(large.where("a != b").distinct(), "large-star")
        discard(links, near)
        near = materialise(_least(large), "small-least")
        small = _hung(large, near, total).select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").unionByName(near.select("a", F.col("least").alias("b")))
        links = materialise(small.distinct(), "small-star")
        discard(large, near)
        # done when no root of a link hangs on another node and every node has one root
        open_ = links.select("b").distinct().join(links.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count() or links.groupBy("a").count().where("count > 1").limit(1).count()
        if not open_:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
