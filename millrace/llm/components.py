"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects a > b in every row."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long) that is not itself the
    smallest of its component; the component is the smallest node reachable.

    Every round is staged, so lineage stays short and nothing but two numbers per round
    comes to the driver. A hub's rows are reduced to its minimum before they are
    shuffled. Rounds end when the links no longer change: then they are stars. Loops and
    repeated links do no harm; without links the result is empty.
    """
    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    stars = stage(stars, "links")
    before = None
    while True:
        digest = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if digest[0] == 0 or digest == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = digest
        stars = stage(_small_star(_large_star(stars)), "stars")
