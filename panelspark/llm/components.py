"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours point at its smallest neighbour (itself included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours point at the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; the root is its component's smallest node.

    ``edges`` has columns u, v of one ordered type.  A round is one large and one small
    star step; edges become stars in a number of rounds that grows with the logarithm of the
    component's size.  Rounds are written to the checkpoint folder; only an edge count and a
    check sum reach the driver.  An empty edge table gives an empty result.
    """
    clean = lambda e: e.where("u != v").distinct()
    edges, before = clean(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).checkpoint(), None
    while True:
        n, mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if n == 0 or (n, mark) == before:
            break
        before = (n, mark)
        edges = clean(_small_star(clean(_large_star(edges)))).checkpoint()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
