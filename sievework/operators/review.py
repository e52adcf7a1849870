"""Gates before a corpus goes out: which combinations it covers, and a sample for people to read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed
from .ordering import hash_key

#: Shares of a stratum that are ranked apart, so that a large one is no one task's work.
SHARES = 32


def coverage_matrix(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """For every set of dimensions the combinations seen, those possible from the values seen, the empty ones and the share covered.

    The rows are counted once by all dimensions; the sets are grouped from these cells. Null is a value of its own.
    """
    dimensions = list(dimensions)
    cells = df.groupBy(*dimensions).agg(F.count("*").alias("rows"))
    held = [F.grouping(d).alias(f"_g{i}") for i, d in enumerate(dimensions)]
    sets = cells.cube(*dimensions).agg(F.sum("rows").alias("rows"), *held).groupBy(*[f"_g{i}" for i in range(len(dimensions))]).agg(
        F.count("*").alias("seen"), F.max("rows").alias("largest"), F.sum("rows").alias("rows"))
    inside = [F.col(f"_g{i}") == 0 for i in range(len(dimensions))]
    names = F.array(*[F.when(i, d) for i, d in zip(inside, dimensions)])
    named = checkpointed(sets.select(F.array_compact(names).alias("set"), *[f"_g{i}" for i in range(len(dimensions))], "seen", "largest", "rows"))
    # a row per set of dimensions: 2 to the number of dimensions
    values = named.filter(F.size("set") == 1).agg(F.map_from_entries(F.collect_list(F.struct(F.col("set")[0].alias("k"), F.col("seen").cast("double").alias("v")))).alias("of"))
    possible = F.aggregate("set", F.lit(1.0), lambda acc, d: acc * F.element_at("of", d)).cast("long")
    met = named.withColumn("_one", F.lit(1)).join(F.broadcast(values.withColumn("_one", F.lit(1))), "_one")
    return met.withColumn("possible", possible).select(
        F.array_join("set", ",").alias("dimensions"), "rows", "seen", "possible", (F.col("possible") - F.col("seen")).alias("empty"),
        (F.col("seen") / F.col("possible")).alias("covered"), "largest")


def empty_cells(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """The combinations of values seen that no row has: the product of the dimensions' values less the cells."""
    values = [df.select(d).distinct() for d in dimensions]
    product = reduce(DataFrame.crossJoin, values)
    cells = df.select(*[F.col(d).alias(f"_m_{d}") for d in dimensions]).distinct()
    return product.join(cells, reduce(Column.__and__, [F.col(d).eqNullSafe(F.col(f"_m_{d}")) for d in dimensions]), "left_anti")


def allocation(df: DataFrame, strata: Sequence[str], n: int) -> DataFrame:
    """``size`` and ``take`` of each stratum: proportional shares of ``n`` rows, the largest remainders rounded up.

    Remainders are compared as integers; ties go to the first stratum in order. Sizes sum to ``n``, or to all rows where there are fewer.
    """
    sizes = df.groupBy(*strata).agg(F.count("*").alias("size"))
    total = df.count()
    n = min(n, total)
    cut = checkpointed(sizes.withColumn("take", F.expr(f"size * {n}L div {max(1, total)}L")).withColumn("_rest", F.expr(f"size * {n}L % {max(1, total)}L")))
    left = n - (cut.agg(F.sum("take")).first()[0] or 0)
    first = cut.orderBy(F.desc("_rest"), *[F.asc_nulls_first(s) for s in strata]).limit(left).select(*[F.col(s).alias(f"_m_{s}") for s in strata], F.lit(1).alias("_more"))
    same = reduce(Column.__and__, [F.col(s).eqNullSafe(F.col(f"_m_{s}")) for s in strata])
    return cut.join(first, same, "left").select(*strata, "size", (F.col("take") + F.coalesce("_more", F.lit(0))).alias("take"))


def review_sample(df: DataFrame, id: str, strata: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows, of each stratum its share, first in hash order of a unique id; adds ``place`` within the stratum.

    Ranks are taken within shares of a stratum first and among the shares' first rows then, so no task sorts a whole stratum.
    """
    strata = list(strata)
    takes = allocation(df, strata, n).select(*[F.col(s).alias(f"_m_{s}") for s in strata], "take")
    same = reduce(Column.__and__, [F.col(s).eqNullSafe(F.col(f"_m_{s}")) for s in strata])
    rows = df.select(id, *strata, hash_key(seed, id).alias("_hash")).join(takes, same).drop(*[f"_m_{s}" for s in strata]).filter("take > 0")
    order = ["_hash", id]
    shared = rows.withColumn("_share", F.pmod(F.xxhash64(id), F.lit(SHARES)))
    first = shared.withColumn("_rank", F.row_number().over(Window.partitionBy(*strata, "_share").orderBy(*order))).filter("_rank <= take")
    chosen = first.withColumn("place", F.row_number().over(Window.partitionBy(*strata).orderBy(*order))).filter("place <= take")
    return df.join(chosen.select(id, "place"), id)
