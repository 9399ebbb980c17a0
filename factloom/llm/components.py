"""Connected components of a link table, without hot tasks and without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.plans.frontier import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link in (a, b); component is the least reachable node.

    Each round replaces every node's links by links to the least node it knows, first for its
    larger neighbours, then for its smaller ones, until nothing changes. The number of links
    never grows, a chain shrinks by a factor per round, and what a node knows is found by
    aggregation, so a node with very many links is no group of its own.
    """
    links = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )
    mark = None
    while True:
        links = written(_small_star(_large_star(links)))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    below = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return below.unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Links (a > b): every neighbour of a node that is larger than it meets the least one known."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    above = links.select(F.col("b").alias("a"), F.col("a").alias("n"))
    return above.join(least, "a").select(F.col("n").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links (a > b): a node and its smaller neighbours meet the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    met = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return met.filter("a <> b").unionByName(least.withColumnRenamed("m", "b")).distinct()
