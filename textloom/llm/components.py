"""Connected components of an edge table, in rounds of joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.tables import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` from links ``(a long, b long)``; root: smallest node reachable.

    Only nodes other than their root are listed. Large stars and small stars take
    turns until nothing changes: the number of rounds grows with the logarithm of the
    number of nodes, and no round makes more edges than it got. Minima are aggregated
    before the shuffle and stored, so that the join with a node of many links is one
    Spark can split. No edges: an empty table. Links of a node to itself and repeated
    links are ignored, links with a null end too.
    """
    whole = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    pairs = (whole.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low"))
             .where("node <> low"))
    current = stored(pairs.distinct(), "links")
    seen = _fingerprint(current)
    while seen[0]:
        large = stored(_large_star(current), "large-star")
        following = stored(_small_star(large), "small-star")
        discard(large)
        now = _fingerprint(following)
        discard(current)
        current = following
        if now == seen:
            break
        seen = now
    return current.select("node", F.col("low").alias("root"))


def _fingerprint(table: DataFrame) -> tuple:
    mixed = F.xxhash64("node", "low")
    row = table.agg(F.count("*"), F.bit_xor(mixed), F.sum(F.shiftrightunsigned(mixed, 24))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest neighbour of that node."""
    both = edges.unionByName(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = stored(both.groupBy("node").agg(F.min("low").alias("least")), "least")
    above = both.where("low > node").join(least, "node")
    return above.select(F.col("low").alias("node"), F.least("node", "least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and all its smaller neighbours move to the smallest of them."""
    least = stored(edges.groupBy("node").agg(F.min("low").alias("least")), "least")
    moved = (edges.join(least, "node").where("low > least")
             .select(F.col("low").alias("node"), F.col("least").alias("low")))
    return moved.unionByName(least.select("node", F.col("least").alias("low"))).distinct()
