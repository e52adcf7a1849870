"""A blocked Bloom filter in DataFrame functions: eight bits in one block of 256.

The filter grows with its keys up to ``filter_bytes``, the bound of what is sent to every
executor; beyond that it passes more rows, which the exact step behind it sorts out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import landed

WORDS = 8
BITS_PER_KEY = 16
FILTER_BYTES = 32 << 20


def _bits() -> list[Column]:
    """One set bit of 32 in each word of a block."""
    return [F.expr(f"shiftleft(1L, cast(shiftright(_bits, {5 * j}) & 31 as int))") for j in range(WORDS)]


def _placed(rows: DataFrame, key: Column, blocks: int) -> DataFrame:
    return rows.withColumns({"_block": F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks)), "_bits": F.xxhash64(key, F.lit(2))})


def maybe_among(rows: DataFrame, key: Column, keys: DataFrame, flag: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Adds ``flag``: false for rows whose key is surely not in the first column of ``keys`` (a landed table)."""
    blocks = max(1, min(filter_bytes // (4 * WORDS), -(-keys.count() * BITS_PER_KEY // (32 * WORDS))))
    words = [F.bit_or(b).alias(f"_w{j}") for j, b in enumerate(_bits())]
    own = _placed(keys.select(F.col(keys.columns[0]).alias("_key")), F.col("_key"), blocks).groupBy("_block").agg(*words)
    hit = reduce(lambda a, b: a & b, [F.col(f"_w{j}").bitwiseAND(b) != 0 for j, b in enumerate(_bits())])
    probed = _placed(rows, key, blocks).join(F.broadcast(own), "_block", "left")
    return probed.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_block", "_bits", *[f"_w{j}" for j in range(WORDS)])


def _probed(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``row``, the whole row in one column, so that no name of its own clashes, ``own``, its key, and ``maybe``, whether the filter knows it."""
    return maybe_among(df.select(F.struct("*").alias("row"), key.alias("own")), F.col("own"), keys, "maybe")


def without(df: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is not in the first column of ``gone``, null equal to null.

    Rows that the filter does not know pass where they lie; only the others are shuffled.
    """
    gone = landed(gone.select(F.col(gone.columns[0]).alias("key")).distinct(), "gone")
    probed = _probed(df, key, gone)
    held = probed.filter("maybe").join(gone, F.col("own").eqNullSafe(F.col("key")), "left_anti")
    return probed.filter("not maybe").unionByName(held).select("row.*")


def among(df: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is in the first column of ``wanted``; only rows that the filter knows are shuffled."""
    wanted = landed(wanted.select(F.col(wanted.columns[0]).alias("key")).distinct(), "wanted")
    return _probed(df, key, wanted).filter("maybe").join(wanted, F.col("own").eqNullSafe(F.col("key")), "left_semi").select("row.*")
