"""Connected components of links, as a few rounds of joins and minima; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each a, the smallest of a and its neighbours; combined before the shuffle, so a hub is no hot key."""
    return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    pairs = _both(links)
    tied = pairs.join(_smallest(pairs), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Links run from the larger to the smaller."""
    low = _smallest(links)
    tied = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionAll(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    spread = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(spread)).first())


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of one type with an order, one row (node, root) for each node of a link; root is the smallest node
    of its component, and a root's own row is left out.

    Links may repeat and point either way; links to oneself and links with a null are ignored. Large-star and small-star
    steps alternate until the links stay the same, which takes about the logarithm of the longest path. Each round is
    written to the shared folder, so a lost executor costs a round at most.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = written(links, "links"), None
    mark = _mark(links)
    while mark != before and mark[0]:
        links = written(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
