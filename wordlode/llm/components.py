"""Connected components of a graph given as pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordlode.session import cut_lineage, gathered


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them; a is the smaller end."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()


def components(pairs: DataFrame, rows: int | None = None) -> DataFrame:
    """node, root: the smallest node of each node's component, for all nodes in a pair.

    Rounds go on until the edges rest, whatever their number; each round is a
    written table. Pairs of a node with itself and NULLs are ignored. ``rows`` says about how many
    pairs there are at most, if that is known.
    """
    edges = (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b").distinct()
    )
    edges = cut_lineage(edges if rows is None else gathered(edges, rows))
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == state or not now["n"]:
            break
        state = now
        # A round never has more edges than the one before.
        edges = cut_lineage(gathered(_small_star(_large_star(edges)), now["n"]))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
