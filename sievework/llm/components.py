"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import join_groups, landed


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches) of every node of the edges ``u``, ``v`` (longs).

    Every round hangs the neighbours of a node to the smallest of them; a node with many
    edges is one row of an aggregate, and its edges meet it where they lie.
    """
    now, before = landed(edges.select("u", "v").filter("u <> v").distinct(), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = landed(_star(both, both, "v > u", now.count()), "edges")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = landed(_star(down, down, "true", large.count(), keep=True), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.join(now.select(F.col("u").alias("node")), "node", "left_anti").select("node", F.col("node").alias("label")))


def _star(edges: DataFrame, whole: DataFrame, which: str, total: int, keep: bool = False) -> DataFrame:
    """Edges from the chosen neighbours of each node to the smallest of the node and its neighbours."""
    least = whole.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    moved = join_groups(edges.filter(which), least, "u", "n", 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()
