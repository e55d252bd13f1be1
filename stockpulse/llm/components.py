"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # minima are written first, here and below: a join of two plain shuffles is one whose hubs Spark can split
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-minima")
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "star-minima")
    hung = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """True if every ``a`` has one ``b`` and no ``b`` is itself an ``a``: each ``b`` is then the root of its nodes."""
    forked = links.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    chained = links.select(F.col("b").alias("a")).distinct().join(links.select("a"), "a", "left_semi")
    return forked.unionByName(chained).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b), longs -> (node, root): root is the smallest node linked to ``node``, over any number of steps.

    Nodes without links have no row. Each round is written to the shared folder. Hubs are met by minima with
    map-side combining and by joins that can be split; no task holds the neighbours of a node.
    """
    links = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(links):
        links = stage(_small_star(stage(_large_star(links), "large-stars")), "stars")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
