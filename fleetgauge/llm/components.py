"""Connected components of a table of links, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import stored


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _to_smallest_of_neighbours(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    return _ordered(
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _to_smallest_below(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(below.unionByName(least.withColumnRenamed("m", "b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Nodes that have links, as ``node``, with their component's smallest node, as ``root``.

    Takes columns a and b. Every round writes its links to the shared folder,
    so lineage stays short and a lost executor costs one round at most; the
    number of rounds grows with the logarithm of the longest path. Only a
    count and a checksum reach the driver.
    """
    edges = stored(_ordered(edges), "links")
    before = None
    while (now := _state(edges)) != before:
        if not now[0]:
            break
        before = now
        edges = stored(_to_smallest_below(_to_smallest_of_neighbours(edges)), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
