"""Connected components of a link table, by alternating large and small stars.

Labels are the smallest node of a component. Every round is a grouped minimum and a join
on the node, written to the shared folder, so a lost executor costs a re-read. A node with
very many links is a large join key; adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.session import stage


def _mark(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return found[0], found[1]


def components(links: DataFrame) -> DataFrame:
    """`links` has node columns a and b. Returns node and root for every node that has a link to another one."""
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    before = _mark(edges)
    while before[0]:
        # Large star: every larger neighbour of a node is linked to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "links")
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
