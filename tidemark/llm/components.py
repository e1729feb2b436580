"""Connected components of an edge table, without collecting edges or groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written first: both inputs of the join below are then plain shuffles,
    # which AQE can split where one node has very many neighbours.
    least = stage(
        both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "large-star"
    )
    linked = both.where(F.col("b") > F.col("a")).join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them; edges run from a to b < a."""
    least = stage(edges.groupBy("a").agg(F.min("b").alias("least")), "small-star")
    moved = edges.join(least, "a").where(F.col("b") != F.col("least"))
    return (
        moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .union(least.select("a", F.col("least").alias("b")))
        .distinct()
    )


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component``, the least node it is connected with.

    Alternates the two star operations of Kiveris et al. (2014) until the edges
    no longer change, after a number of rounds that grows with the logarithm of
    the longest chain. Each round is written to the shared folder, so that a
    lost executor never repeats earlier rounds. Nodes are any ordered type; the
    roots themselves, self-links and links with a NULL end have no row.
    """
    now = stage(
        edges.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        now = stage(_small_star(stage(_large_star(now), "stars")), "links")
