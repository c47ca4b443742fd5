"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
               .where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; ``edges`` point downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns u and v): the smallest node it can reach.

    Each round is two grouped minima with joins, written to the shared folder, so a
    lost executor repeats one round at most.  Rounds grow with the logarithm of a
    component's length.  Loops (u = v) only name their node.
    """
    nodes = edges.select("u").unionAll(edges.select("v")).distinct().select(F.col("u").alias("node"))
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "edges")
    print_of = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before, after = None, print_of(now)
    while before != after:
        now = staged(_small_star(_large_star(now)), "edges")
        before, after = after, print_of(now)
    least = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(least, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
