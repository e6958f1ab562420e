"""Connected components of links, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import stored

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("a"), F.least("m", "u").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return (
        links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node reachable.

    Large-star and small-star rounds: the links turn into stars around the roots in a number of
    rounds that grows with the logarithm of the nodes.  Only aggregations that combine before
    the shuffle and joins; a round's links are written, so its lineage ends there.  The driver
    sees two numbers per round.
    """
    now = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(),
        "links",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = now.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        now = stored(_small_star(_large_star(now)), "links")
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
