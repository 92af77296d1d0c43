"""Connected components by alternating large-star and small-star steps, all of them grouped aggregates and equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import discard, materialize


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each edge leads to a node from which none goes on, and only one from each node."""
    onward = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").select("a")
    return edges.groupBy("a").count().filter("count > 1").select("a").union(onward).isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component), written: every node of links, and the smallest node reachable from it, itself included.

    links may repeat, be in either order, or link a node with itself; rows with a null end are no links. Nodes may be of any
    type that can be ordered. Each step takes minima per node (combined before the shuffle) and joins them back, so no
    neighbour list is ever gathered; a node with very many links is a skewed join, which Spark splits. The edges are
    written to the shared folder after each round, so that a lost executor costs one round at most.
    """
    loops = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    edges = materialize(_oriented(loops))
    nodes = loops.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    for _ in range(rounds):
        if _settled(edges):
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, edges = edges, materialize(_oriented(small.union(least.select("a", F.col("m").alias("b")))))
        discard(old)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    out = nodes.join(edges.withColumnRenamed("a", "node"), "node", "left")
    out = materialize(out.select("node", F.coalesce("b", "node").alias("component")))
    discard(edges)
    return out
