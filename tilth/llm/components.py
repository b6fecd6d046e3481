"""Connected components by alternating large-star and small-star steps.

Edges stay in Spark all along; each round pre-aggregates a node's smallest neighbour on
the map side and joins it back, so a node with very many edges is a skewed join key, not
one group in a task.  Rounds are checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import materialize


def _star(pairs: DataFrame) -> DataFrame:
    """Link every neighbour v of u to the smallest node of u's star; pairs are (u, v)."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    star = _star(edges)
    hung = star.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(star.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link to
    another one.  Loops and nulls are ignored; no links give an empty table.

    Ends when a round leaves the edges as they were (compared by count and an
    order-free sum of hashes); the number of rounds grows with the logarithm of the
    longest chain, and running past ``max_rounds`` is an error, not a shorter answer."""
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where(F.col("u") != F.col("v")).distinct())
    seen = _digest(edges)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        edges = materialize(_small(_large(edges)))
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)


def _digest(edges: DataFrame) -> tuple[int, int, int]:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(h, 32)).alias("x"),
                    F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("y")).first()
    return row["n"], row["x"] or 0, row["y"] or 0
