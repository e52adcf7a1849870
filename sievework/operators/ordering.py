"""Hash order, exact selection by rank and global positions without one big task.

Rows are cut into many ranges of the order by a coarse key. Counting the ranges
gives a small frame of offsets; only inside a range are rows ever sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed

HASH_RANGES = 16 ** 4


def hash_key(seed: int, *keys: str) -> Column:
    """The seeded random order of the library: MD5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def shuffled(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """Rows in a seeded order that does not depend on partitioning."""
    return df.orderBy(hash_key(seed, *keys), *keys)


def _offsets(ranges: DataFrame) -> DataFrame:
    """``_before`` and ``_total`` per range; at most ``HASH_RANGES`` rows come in."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ranges.select(
        "_range", "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(everything).alias("_total"),
    )


def with_position(df: DataFrame, id: str, name: str = "position") -> DataFrame:
    """Zero-based position of each row in the order of a unique id.

    Rows are dealt by sampled ranges of the id, so the ranges hold about equally
    many rows whatever gaps the ids have, and sorted inside. The dealt rows are
    written once; their place in the range plus the sizes of the ranges before is
    the position. Only one row per range is ever ordered in one task.
    """
    dealt = df.repartitionByRange(id).sortWithinPartitions(id)
    placed = checkpointed(dealt.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place")))
    ranges = placed.groupBy("_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")


def mark_first(
    df: DataFrame,
    seed: int,
    key: str,
    size: Callable[[Column], Column],
    name: str,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Flag the first ``size(total)`` rows in hash order of a unique key.

    ``facts`` is an optional one-row frame whose columns ``size`` may use. Only
    the one range that the cut falls into is ranked; all other rows are decided
    by their range, so nothing but counts is shuffled.
    """
    ordered = df.withColumn("_hash", hash_key(seed, key)).withColumn(
        "_range", F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int"))
    offsets = _offsets(ordered.groupBy("_range").agg(F.count("*").alias("_rows")))
    if facts is not None:
        offsets = offsets.withColumn("_one", F.lit(1)).join(
            F.broadcast(facts.withColumn("_one", F.lit(1))), "_one").drop("_one")
    offsets = offsets.select(
        "_range", "_rows", (size(F.col("_total")).cast("long") - F.col("_before")).alias("_left"))
    split = offsets.filter((F.col("_left") > 0) & (F.col("_left") < F.col("_rows")))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("_hash", key))
    last = (
        ordered.select("_range", "_hash", key)
        .join(F.broadcast(split), "_range")
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_left"))
        .select("_range", F.struct("_hash", key).alias("_last"))
    )
    decided = offsets.join(F.broadcast(last), "_range", "left")
    inside = (F.col("_left") >= F.col("_rows")) | F.coalesce(F.struct("_hash", key) <= F.col("_last"), F.lit(False))
    return (
        ordered.join(F.broadcast(decided), "_range")
        .withColumn(name, inside)
        .drop("_hash", "_range", "_rows", "_left", "_last")
    )
