"""Connected components of an edge table, with shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.storage import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round: link neighbours of each node to the smallest node among it and them.

    ``edges`` has a > b.  The large star moves greater neighbours only, the small star the node
    itself and smaller neighbours.
    """
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("node", "next")
        least = both.groupBy("node").agg(F.min("next").alias("m"))
        least = least.select("node", F.least("node", "m").alias("m"))
        moved = both.where("next > node").join(least, "node").select(F.col("next").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``edges``.

    ``edges`` has two long columns (a, b) in any order; loops and nulls are ignored.  Large and
    small stars alternate until nothing changes; each round ends in a stored table, minima are
    combined before the shuffle, so that a node with very many edges is no task's whole work.
    Nodes without an edge to another node are not returned.
    """
    edges = edges.toDF("x", "y").where("x <> y")
    edges = edges.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    edges = stored(edges, "edges")
    mark = lambda df: df.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    before = mark(edges)
    while before[0]:
        edges = stored(_stars(_stars(edges, True), False), "edges")
        now = mark(edges)
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b"), F.col("b"))).groupBy("node").agg(
        F.min("component").alias("component")
    )
