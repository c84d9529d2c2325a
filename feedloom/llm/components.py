"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import salted_join


def _star(links: DataFrame, smaller: bool) -> DataFrame:
    """Hang neighbours on the smallest node around: larger ones (``smaller`` False) or those not above the node.

    The least neighbour of a node is an aggregate that combines on the map side; it goes back to the node's links by a
    join that spreads nodes with many links.
    """
    if smaller:
        around = links
    else:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a is the node, b a neighbour; in `links` a > b
    least = materialize(
        around.groupBy("a").agg(F.min("b").alias("_m"), F.count(F.lit(1)).alias("_n")).withColumn(
            "_least", F.least("_m", "a")
        ).drop("_m"),
        "least",
    )
    met = salted_join(around, least, ["a"], "_n", ["a", "b"])
    if smaller:
        moved = met.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter(F.col("a") > F.col("b"))
        return moved.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()
    return met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between integers -> (node, component): for every linked node the smallest node it reaches.

    Links are hung on smaller nodes in turns (large star, small star) until nothing changes; every turn is a written
    table, so a lost executor costs one turn. The number of turns grows with the logarithm of the nodes.
    """
    now = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = materialize(now.distinct(), "links")
    seen = None
    while True:
        now = materialize(_star(materialize(_star(now, False), "large_star"), True), "small_star")
        mark = F.xxhash64("a", "b")
        # two sums of halves of the links' hashes tell whether the turn changed anything
        state = now.agg(
            F.count(F.lit(1)),
            F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))),
            F.sum(F.shiftrightunsigned(mark, 32)),
        ).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
