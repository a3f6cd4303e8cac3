"""Connected components of a graph too large for one task, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import kept


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of an edge set."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is the least node of its component.

    ``links`` holds pairs (a, b) of longs, in any direction, repeated or not; a pair of equal
    nodes links nothing. Each round hooks the larger neighbours of a node to its least neighbour
    (large star), then the smaller ones (small star); rounds grow with the logarithm of the
    longest path. The least neighbour is an aggregate, and joins of it meet freshly stored sides,
    so adaptive execution can split a node with very many links.
    """
    edges = kept(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = kept(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        )
        edges = kept(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
