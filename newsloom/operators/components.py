"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns (node, root) for every node of the edges (a, b); the root is the least node.

    Alternating large-star and small-star steps (Kiveris et al. 2014): the number of rounds
    grows with the logarithm of the component's size, not with its diameter. Minima combine
    on the map side, so a node with very many edges does not gather them in one task. Each
    round is staged. Loops and rows with a null end are ignored.
    """
    now = stage(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        now = stage(small)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
