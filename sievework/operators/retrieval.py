"""Nearest passages with their sources: an inverted file of vectors built and searched in Spark.

Every row lies in the list of its nearest centre. A query asks the lists of its nearest centres (its probes); each
list is cut into blocks and its queries into slices, so a task holds one block and one slice and returns the best few of
a query there. Scores are exact cosines of unit vectors; only which lists are asked is an approximation, and asking all is
exact. ``recall`` measures what fewer probes lose.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import preview
from ..session import checkpointed
from .cells import BLOCK_ROWS, block_count, dense, each_cell, run_cells
from .cluster import kmeans, kmeans_clusters
from .grouping import join_groups

#: Queries of one slice of a list.
SLICE = 1_024


@dataclass
class VectorIndex:
    """``rows``: ``id``, ``vector``, ``list``; ``centres`` by list."""

    rows: DataFrame
    centres: np.ndarray
    total: int

    def lists(self) -> DataFrame:
        """Rows of each list."""
        return self.rows.groupBy("list").agg(F.count("*").alias("rows"))


def vector_index(df: DataFrame, id: str, vector: str, lists: int = 64, seed: int = 42) -> VectorIndex:
    """Index every row of unit vectors; the centres are k-means over all rows."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    n = rows.count()
    models = kmeans(rows, "id", "vector", [max(1, min(lists, n))], 1, seed)
    placed = kmeans_clusters(rows, "id", "vector", models).select("id", F.col("cluster").alias("list"))
    return VectorIndex(checkpointed(rows.join(placed, "id")), next(iter(models.values()))[1], n)


def search(index: VectorIndex, queries: DataFrame, id: str, vector: str, k: int = 5, probes: int | None = None, block_rows: int = BLOCK_ROWS, skip_same: bool = False) -> DataFrame:
    """``query``, ``rank``, ``id``, ``score`` of the ``k`` nearest rows in the asked lists, ties by id; ``skip_same`` leaves out a query's own id."""
    asked = len(index.centres) if probes is None else min(probes, len(index.centres))
    centres = index.centres

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        gaps = (centres * centres).sum(1) - 2 * (points @ centres.T)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :asked].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1, dtype=np.int32) * asked), pa.array(order.ravel()))

    wanted = checkpointed(queries.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.explode(nearest(vector)).alias("list")))
    held = index.lists().withColumn("_blocks", block_count(F.col("rows"), block_rows))
    asks = wanted.groupBy("list").agg(F.count("*").alias("asks"), block_count(F.count("*"), SLICE).alias("_slices"))
    sizes = held.join(asks, "list").select("list", (F.col("rows") + F.col("asks")).alias("n"), "_blocks", "_slices")
    total = index.total + wanted.count()
    here = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def dealt(rows: DataFrame, query: bool) -> DataFrame:
        met = join_groups(rows.select("list", "id", "vector"), sizes, ["list"], "n", total)
        met = met.withColumn("_b", every("_blocks") if query else here("_blocks")).withColumn("_s", here("_slices") if query else every("_slices"))
        return met.select(F.unhex(F.md5(F.to_json(F.struct("list", "_b", "_s")))).alias("_cell"), F.lit(query).alias("asks"), "id", "vector")

    def best(table: pa.Table) -> Iterator[pa.RecordBatch]:
        asks, ids = table["asks"].to_numpy(zero_copy_only=False), table["id"].to_numpy()
        if asks.all() or not asks.any():
            return
        points, own = dense(table, "vector"), ids[~asks]
        scores = np.round(np.clip(points[asks] @ points[~asks].T, -1.0, 1.0), 9)
        if skip_same:
            scores[ids[asks][:, None] == own[None, :]] = -2.0
        by_id = np.argsort(own, kind="stable")
        order = by_id[np.argsort(-scores[:, by_id], axis=1, kind="stable")[:, :k]]
        values = np.take_along_axis(scores, order, 1)
        use = values >= -1.0
        yield pa.record_batch([pa.array(np.repeat(ids[asks], use.sum(1))), pa.array(own[order][use]), pa.array(values[use])], names=["query", "id", "score"])

    found = run_cells(dealt(index.rows, False).unionByName(dealt(wanted, True)), each_cell(best), "query long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "rank", "id", "score")


def with_sources(found: DataFrame, passages: DataFrame, id: str, text: str, source: str, n: int = 200) -> DataFrame:
    """Add the source and the beginning of each passage found."""
    known = passages.select(F.col(id).cast("long").alias("id"), F.col(source).alias("source"), preview(text, n).alias("passage"))
    return found.join(known, "id", "left")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """The share of the exact answers that a search found."""
    hits = exact.select("query", "id").join(found.select("query", "id", F.lit(1).alias("hit")), ["query", "id"], "left")
    return hits.agg(F.count("*").alias("answers"), F.sum(F.coalesce("hit", F.lit(0))).alias("found"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
