"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _stars(edges: DataFrame) -> DataFrame:
    """Each node and its neighbours get linked to the smallest node among them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    joined = _stars(both).withColumn("m", F.least("a", "m"))
    return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = _stars(down)
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = joined.select("a", F.col("m").alias("b"))
    return moved.union(own).filter(F.col("a") != F.col("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of its component.

    Rounds repeat until the links no longer change, which is when all are stars. Each round is a
    stored table, the driver sees two numbers for each. Links to oneself are ignored.
    """
    links = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    seen = None
    while True:
        links = common.stored(_small(_large(links).distinct()).distinct(), "components")
        sums = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(sums) == seen:
            break
        seen = tuple(sums)
    tails = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tails.union(links.select(F.col("b"), F.col("b")).distinct())
