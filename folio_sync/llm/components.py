"""Connected components of a graph that is spread over a cluster.

Union-find with links in place of an array: every round hangs a node's larger neighbours,
and then itself and its smaller ones, on the smallest node around, until each tree is a star
around its smallest node. The rounds are joins and aggregates; a node with very many
neighbours is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.llm.common import discarded, written


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node, component, as a written table: the smallest node that each node of `edges(a, b)` is connected with.

    Nodes are longs; direction, repeated edges and loops do not matter; nodes without an edge to
    another do not appear."""
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        hung = written(
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "edges")
        low = hung.groupBy("a").agg(F.min("b").alias("low"))
        down = hung.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        last, edges = edges, written(down.unionByName(low.withColumnRenamed("low", "b")).distinct(), "edges")
        discarded(last, hung)
        after = _state(edges)
        if after == before:
            break
        before = after
    found = written(
        edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "components")
    discarded(edges)
    return found
