"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    around = _both_ways(links)
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, work: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``) but the roots; the root is the smallest node.

    Sums over a node's neighbours are combined on the map side, and the joins can be split, so a node with very many
    links is no hot key. The number of rounds grows with the logarithm of the longest path; each round is a table
    in ``work``.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = staged(links, f"{work}/links-0")
    turn, before = 0, None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        turn, before = turn + 1, mark
        wide = staged(_large_star(links).distinct(), f"{work}/links-{turn}-large")
        links = staged(_small_star(wide).distinct(), f"{work}/links-{turn}")
