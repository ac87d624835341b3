"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours to the smallest node nearby: the larger neighbours of each node, or the node and its smaller ones."""
    around = _both(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "node")
    met = around.join(least, F.col("a") == F.col("node"))
    if large:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("node", "m"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (two columns of longs, nulls and loops ignored); the root is the smallest node.

    A hub with very many neighbours meets only its own smallest neighbour, in a join that adaptive execution may split;
    no group is gathered. Each round is checkpointed. It ends when a round changes nothing, after a number of rounds
    that grows with the logarithm of the nodes.
    """
    a, b = edges.columns[:2]
    now = cut_lineage(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b").distinct())
    mark = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
    seen = None
    while True:
        now = cut_lineage(_star(_star(now, True), False))
        state = now.agg(mark.alias("s")).first()["s"]
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct().toDF("node", "root"))
