"""Exact copies, template caps and keep-last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .grouping import join_groups
from .ordering import hash_key


def exact_duplicate_groups(df: DataFrame, text: str, id: str, width: int = 2000) -> DataFrame:
    """Texts that occur more than once: first id, count and the beginning."""
    rows = df.select(id, F.sha2(text, 256).alias("_digest"), F.substring(text, 1, width).alias("message"))
    groups = rows.groupBy("_digest").agg(
        F.min(id).alias("first_id"), F.count("*").alias("count"), F.min_by("message", id).alias("message"))
    return groups.filter("count > 1").drop("_digest")


def exact_duplicate_members(df: DataFrame, text: str, id: str) -> DataFrame:
    """Members of those groups, one row each (a group may be of any size)."""
    rows = df.select(F.col(id), F.coalesce(F.sha2(text, 256), F.lit("")).alias("_digest"))
    groups = rows.groupBy("_digest").agg(F.min(id).alias("first_id"), F.count("*").alias("count")).filter("count > 1")
    return join_groups(rows, groups, ["_digest"], "count", rows.count()).select("first_id", "count", id)


def exact_dedup(df: DataFrame, form: Column, id: str) -> DataFrame:
    """Rows that are the first of their form."""
    first = df.select(form.alias("_form"), id).groupBy("_form").agg(F.min(id).alias(id)).select(id)
    return df.join(first, id, "left_semi")


def cap_per_key(df: DataFrame, key: str, cap: int, seed: int, id: str) -> DataFrame:
    """At most ``cap`` rows per key in hash order. Spark limits each key before
    the shuffle already, so a key of any size sends few rows."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(hash_key(seed, id), id))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= cap).drop("_rank")


def keep_last(df: DataFrame, id: str, order: str) -> DataFrame:
    """The last row of each id."""
    rank = F.row_number().over(Window.partitionBy(id).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
