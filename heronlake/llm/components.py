"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.session import settle


def _mark(links: DataFrame) -> tuple:
    """Changes when the set of links changes."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _to_least(links: DataFrame) -> DataFrame:
    """Adds `least`: the least node among a and all b linked from a. Counted per a before the join."""
    least = links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("l_a"), F.least("a", "low").alias("least"))
    return links.join(least, F.col("a") == F.col("l_a")).drop("l_a")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the least node of its component.

    Every round links the larger neighbours of each node to the least of its neighbourhood, then the smaller ones, until
    only stars are left; the number of rounds grows with the logarithm of the longest path. Each round is stored.
    """
    links = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = _mark(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = _to_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        star = _to_least(larger)
        links = settle(
            star.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(star.select("a", F.col("least").alias("b"))).filter("a <> b").distinct(), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
