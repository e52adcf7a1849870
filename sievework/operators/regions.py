"""Pair work that skips what an angle rules out.

Rows are dealt by the nearest of a bounded sample of centres. A region (the rows of a bucket
at one centre) has a radius, the largest angle to its centre, so two rows of different regions are at least the
centres' angle less both radii apart, and their product is at most the cosine of that. Only pairs of regions whose bound
reaches a threshold become cells. Nothing above the threshold is lost, and
where rows lie in clusters most pairs of regions never meet. Vectors without any cluster keep all their cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from ..session import checkpointed
from .cells import BLOCK_ROWS, Blocks, block_count, part_name, run_cells, whole_cells
from .grouping import join_groups

#: The most centres, and the rows that call for one more.
CENTRES, ROWS_A_CENTRE = 256, 512
#: What rounding may take from an angle.
SLACK = 1e-6


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def centres(rows: DataFrame, id: str, vector: str, most: int = CENTRES, rows_a_centre: int = ROWS_A_CENTRE) -> np.ndarray:
    """Unit vectors of the rows that come first in hash order, fewer for few rows; at most ``most`` come to the driver."""
    wanted = min(most, rows.count() // rows_a_centre)
    picked = rows.select(F.xxhash64(id).alias("h"), vector).orderBy("h").limit(wanted).collect() if wanted > 1 else []
    if not picked:
        return np.zeros((0, 0))
    found = np.array([r[1] for r in picked], np.float64)
    sizes = np.linalg.norm(found, axis=1, keepdims=True)
    return np.unique((found / np.where(sizes > 0, sizes, 1.0))[sizes.ravel() > 0], axis=0)


def with_centre(rows: DataFrame, vector: str, at: np.ndarray) -> DataFrame:
    """Adds ``_centre``, the nearest one, with ``_angle`` to it and ``_norm``, the vector's length."""
    @F.arrow_udf("struct<centre: int, angle: double, norm: double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        x = _matrix(vectors)
        norms = np.linalg.norm(x, axis=1)
        if len(at):
            cosines = (x / np.where(norms > 0, norms, 1.0)[:, None]) @ at.T
            own = cosines.argmax(1)
            angles = np.where(norms > 0, _angles(cosines[np.arange(len(x)), own]), 0.0)
        else:
            own, angles = np.zeros(len(x), np.int64), np.full(len(x), np.pi)
        return pa.StructArray.from_arrays([pa.array(own.astype(np.int32)), pa.array(angles), pa.array(norms)], ["centre", "angle", "norm"])

    found = rows.withColumn("_near", nearest(vector))
    return found.select(*rows.columns, F.col("_near.centre").alias("_centre"), F.col("_near.angle").alias("_angle"), F.col("_near.norm").alias("_norm"))


@dataclass
class Regions:
    """Regions of a table of rows with centres, and the bounds between them."""

    rows: DataFrame
    bucket: list[str]
    table: DataFrame
    pairs: DataFrame
    total: int
    blocks: Blocks | None = None

    def run(
        self, work: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]], schema: StructType | str, threshold: float | None = None, which: str = "true",
        rows: DataFrame | None = None, id: str = "id", asked: bool = False,
    ) -> DataFrame:
        """``work`` on the cells of the region pairs that may reach ``threshold``; a bucket of one block's size is one cell.

        ``which`` chooses region pairs by ``bound`` and ``same``. ``rows`` (default: all) have the columns of the regions' rows and more;
        with ``asked`` only cells in which a row ``asks`` are met. Without other rows, the blocks are written once for all runs.
        """
        keys = [*self.bucket, "_centre"]
        chosen = self.pairs.filter(which) if threshold is None else self.pairs.filter(which).filter((F.col("bound") >= threshold) | F.col("same"))
        met = join_groups(self.rows if rows is None else rows, self.table.select(*keys, "_rows", "_blocks", "_small"), keys, "_rows", self.total)
        dropped = ("_angle", "_norm", "_rows", "_blocks", "_small", "_centre")
        block = F.pmod(F.xxhash64(id), F.col("_blocks")).cast("int")
        own = whole_cells(met.filter("_small").drop(*dropped), self.bucket)
        if which.startswith("not same"):
            own = own.filter(F.lit(False))
        if asked:
            own = own.join(own.filter("asks").select("_cell").distinct(), "_cell", "left_semi")
        found = run_cells(own, work, schema)
        if self.table.filter("not _small").isEmpty():
            return found
        if rows is not None or self.blocks is None:
            blocks = Blocks(met.filter("not _small").withColumn("part", part_name(keys, block)).drop(*dropped))
            if rows is None:
                self.blocks = blocks
        else:
            blocks = self.blocks
        a, b = F.col("_i"), F.col("_j")
        pairs = chosen.join(self.table.filter("_small").select(*self.bucket).distinct(), self.bucket, "left_anti").select(
            "*", F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)).alias("_i")).select(
            "*", F.explode(F.sequence(F.when(F.col("same"), F.col("_i")).otherwise(0), F.col("b_blocks") - 1)).alias("_j"))
        part = lambda centre, k: part_name([*[F.col(c) for c in self.bucket], F.col(centre).alias("_centre")], k)
        pairs = pairs.select(part("a", a).alias("a"), part("b", b).alias("b"))
        if asked:
            names = checkpointed(met.filter("asks and not _small").select(part_name(keys, block).alias("_p")).distinct())
            sides = [names.select(F.col("_p").alias(x), F.lit(True).alias(f"_{x}")) for x in "ab"]
            pairs = pairs.join(sides[0], "a", "left").join(sides[1], "b", "left").filter("_a or _b").select("a", "b")
        return found.unionByName(blocks.run(pairs, work, schema))

    def work(self, threshold: float) -> DataFrame:
        """``cells`` of all pairs of blocks, and those ``taken`` and ``skipped`` at a threshold."""
        n = F.when(F.col("same"), F.col("a_blocks") * (F.col("a_blocks") + 1) / 2).otherwise(F.col("a_blocks") * F.col("b_blocks")).cast("long")
        taken = F.when((F.col("bound") >= threshold) | F.col("same"), n).otherwise(0)
        return self.pairs.agg(F.coalesce(F.sum(n), F.lit(0)).alias("cells"), F.coalesce(F.sum(taken), F.lit(0)).alias("taken")).withColumn(
            "skipped", F.col("cells") - F.col("taken"))


def regions(rows: DataFrame, bucket: Sequence[str], id: str, vector: str, block_rows: int = BLOCK_ROWS, most: int = CENTRES, rows_a_centre: int = ROWS_A_CENTRE) -> Regions:
    """Deal rows of unit vectors (or zeros) into regions within buckets; bucket columns are never null."""
    bucket = list(bucket)
    at = centres(rows, id, vector, most, rows_a_centre)
    placed = checkpointed(with_centre(rows, vector, at))
    whole = Window.partitionBy(*bucket)
    table = checkpointed(placed.groupBy(*bucket, "_centre").agg(
        F.count("*").alias("_rows"), F.max("_angle").alias("_radius"), F.max("_norm").alias("_norm"), block_count(F.count("*"), block_rows).alias("_blocks")).withColumn(
        "_small", F.sum("_rows").over(whole) <= block_rows))
    between = _angles(at @ at.T) if len(at) else np.zeros((1, 1))

    @F.arrow_udf("double")
    def apart(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(between[a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)])

    sides = [table.select(*[F.col(c).alias(f"{s}_{c}") for c in bucket], *[F.col(x).alias(f"{s}{x}") for x in ("_centre", "_radius", "_norm", "_blocks", "_small")]) for s in "ab"]
    met = sides[0].join(sides[1], reduce(Column.__and__, [F.col(f"a_{c}") == F.col(f"b_{c}") for c in bucket], F.col("a_centre") <= F.col("b_centre")))
    same = F.col("a_centre") == F.col("b_centre")
    gap = F.when(same, 0.0).otherwise(F.greatest(F.lit(0.0), apart("a_centre", "b_centre") - F.col("a_radius") - F.col("b_radius") - SLACK))
    bound = F.greatest(F.lit(0.0), F.col("a_norm") * F.col("b_norm") * F.cos(gap)) + SLACK
    pairs = checkpointed(met.filter(same | ~F.col("a_small")).select(
        *[F.col(f"a_{c}").alias(c) for c in bucket], F.col("a_centre").alias("a"), F.col("b_centre").alias("b"), same.alias("same"),
        F.when(F.col("a_small"), 1).otherwise(F.col("a_blocks")).alias("a_blocks"), F.col("b_blocks"), bound.alias("bound")))
    return Regions(placed, bucket, table, pairs, placed.count())
