"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) of every node with a link to another.

    ``links`` has the columns ``a`` and ``b``, in any order and number. Each round hangs every
    node below the smallest node next to it, until all trees are stars; the number of rounds grows
    with the logarithm of the longest path. Rounds are written to the shared folder. Only the
    smallest neighbour is aggregated, so a node with very many links is no large task.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = kept(ordered.where("a <> b").distinct(), "links")
    while not _stars(links):
        links = kept(_small_star(_large_star(links)).distinct(), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), "m")
    return moved.union(least).select("a", F.col("m").alias("b"))


def _stars(links: DataFrame) -> bool:
    """Whether each node hangs below one other and that one below none."""
    found = links.agg(F.count("*").alias("n"), F.count_distinct("a").alias("d")).first()
    if found["n"] != found["d"]:
        return False
    tops = links.select(F.col("b").alias("a")).distinct()
    return links.join(tops, "a", "left_semi").isEmpty()
