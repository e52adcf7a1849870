"""Grouping columns under names that no working column can collide with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ALL = "_all"


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int, least: int = 1_000) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, one row per ``keys`` with its number of rows in ``size``.

    Groups of more than a 5,000th of all rows (there are fewer than 5,000 of them, so
    their broadcast is bounded) meet their rows where these lie; only the rest is shuffled.
    ``total`` is the number of rows or a bound of it. Keys are never null.
    """
    keys, limit = list(keys), max(least, total // 5_000)
    hot, cold = groups.filter(F.col(size) > limit), groups.filter(F.col(size) <= limit)
    if total <= limit:
        return rows.join(cold, keys)
    here = rows.join(F.broadcast(hot), keys)
    there = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(cold, keys)
    return here.unionByName(there)


def with_keys(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with copies of its grouping columns, one constant when there are none."""
    if not by:
        return df.withColumn(ALL, F.lit(1)), [ALL]
    keys = [f"_key{i}" for i in range(len(by))]
    return df.select("*", *[F.col(b).alias(k) for b, k in zip(by, keys)]), keys


def named(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The result of a grouped job under the caller's names."""
    if not by:
        return df.drop(ALL)
    keys = [f"_key{i}" for i in range(len(by))]
    return df.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], *[c for c in df.columns if c not in keys])
