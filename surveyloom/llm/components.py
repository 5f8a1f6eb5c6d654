"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut


def _large(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link: the smallest node reachable. `edges` has long columns a and b.

    Rounds grow with the logarithm of the longest path; each is a written table.
    """
    e, before = cut(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "links"), None
    while True:
        e = cut(_small(_large(e)).distinct(), "links")
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = mark
