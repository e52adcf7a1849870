"""Shards of equal size by sampled splitters.

A sample of the keys, drawn with a probability that grows with a record's size, gives splitters at
equal steps of size; the records are dealt into the ranges between them. A range that turns out to hold too many rows
(small records, or one key of very many rows) is subdivided at keys drawn inside it, until none
does. Every record's key ends in a number of its own, so a range of one key can be cut as well. The ranges'
totals, and running sums inside each range, give every record its exact place in the order of the keys, and
from it the shard: law ``bytes`` cuts the running size, law ``rows`` the running count, into equal parts.

So shards of law ``bytes`` differ by less than the two largest records, those of law ``rows`` by one row, whatever
the sample was; the sample only decides how even the work is. Records of one key are neighbours: they share a
shard unless a boundary falls among them.

A range holds about ``RANGE_ROWS`` rows, and there are 64 ranges at least. Sixteen keys per range come to the driver, and a count per range.

Defined results: null keys come first; records of equal keys are told apart by their row; a null size counts as 1, as
does any below 1; an empty table gives an empty result; a table of fewer records than shards leaves shards
empty. Texts take part only through size and key, so long ones need no memory, unless they are among the columns carried. Columns
named ``shard`` or ``slot`` are replaced; no other name clashes, as a record travels as one column.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import landed

RANGE_ROWS = 2_000_000
RANGES = 64
DRAWS = 16
#: A range of more than so many times its share of the rows is subdivided.
OVERFULL = 2


def _chance(seed: int) -> Column:
    """A number in 0..1 that depends on the row alone."""
    return F.xxhash64("at", F.lit(seed)) / F.lit(2.0 ** 64) + 0.5


def _tuple(key: tuple) -> tuple:
    """What Python orders as Spark orders the key: nulls first."""
    return tuple((x is not None, 0 if x is None else x) for x in key)


def _ranged(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Adds ``range``: the number of splitters up to the row's key."""
    @F.arrow_udf("int")
    def find(keys: pa.Array) -> pa.Array:
        return pa.array([bisect_right(splitters, _tuple(k)) for k in zip(*[c.to_pylist() for c in keys.flatten()])], pa.int32())

    return rows.withColumn("range", find("key") if splitters else F.lit(0))


def _draw(rows: DataFrame, chance: Column, weight: Column, seed: int, *more: str) -> list:
    """Drawn keys in order, each with what it stands for."""
    drawn = rows.filter(_chance(seed) < chance).select("key", weight.alias("weight"), *more).collect()
    return sorted(((_tuple(r["key"]), *r[1:]) for r in drawn))


def _quantiles(drawn: list, pieces: int) -> list[tuple]:
    """Keys at equal steps of the drawn weight."""
    total, sums, out = sum(x[1] for x in drawn), 0.0, []
    for x in drawn:
        sums += x[1]
        if len(out) < pieces - 1 and sums >= total * (len(out) + 1) / pieces:
            out.append(x[0])
            while len(out) < pieces - 1 and sums >= total * (len(out) + 1) / pieces:
                out.append(x[0])
    return out


def splitters(rows: DataFrame, n: int, total: int) -> list[tuple]:
    """Splitters between ranges of about equal size and none too many rows, in order.

    ``rows``: landed ``key``, ``at`` and ``size`` of every record.
    """
    ranges = max(RANGES, -(-n // RANGE_ROWS))
    step = total / (DRAWS * ranges)
    found = sorted(set(_quantiles(_draw(rows, F.col("size") / step, F.greatest("size", F.lit(step)), 0), ranges)))
    most, seed = max(1, OVERFULL * n // ranges), 0
    while True:
        counts = {r["range"]: r["n"] for r in _ranged(rows, found).groupBy("range").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).collect()}
        if not counts:
            return found
        seed += 1
        pieces = {k: -(-2 * x // most) for k, x in counts.items()}
        chance = F.lit(min(1.0, DRAWS * max(pieces[k] / x for k, x in counts.items())))
        inside = _ranged(rows, found).filter(F.col("range").isin(list(counts)))
        drawn = _draw(inside, chance, F.lit(1.0), seed, "range")
        for k, p in pieces.items():
            found += _quantiles([x for x in drawn if x[2] == k], p)
        found = sorted(set(found))


def sharded(df: DataFrame, keys: Sequence[str], size: str, shards: int = 8, law: str = "bytes") -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot``, the place in the shard (from 0), in the order of ``keys``.

    Keys are columns of strings, binaries, integers or dates.
    """
    if law not in ("bytes", "rows") or shards < 1:
        raise ValueError(f"no such law or number of shards: {law}, {shards}")
    one = F.lit(1).cast("long")
    weight = F.greatest(F.coalesce(F.col(size).cast("long"), one), one) if law == "bytes" else one
    carried = [c for c in df.columns if c not in ("shard", "slot")]
    rows = landed(df.select(F.struct(*carried).alias("record"), F.struct(*keys).alias("named"), weight.alias("size"), F.monotonically_increasing_id().alias("at")), "records")
    rows = rows.select("record", F.struct("named.*", F.col("at").alias("_at")).alias("key"), "size", "at")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if n == 0:
        return df.select(*carried, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ranged = _ranged(rows, splitters(rows.select("key", "at", "size"), n, total))
    placed = landed(ranged.select("record", "range", "size", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("size_before"),
                                  F.count(F.lit(1)).over(inside).alias("rows_before")), "placed")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("range").agg(F.sum("size").alias("sizes"), F.count(F.lit(1)).alias("rows")).select(
        "range", F.coalesce(F.sum("sizes").over(earlier), F.lit(0)).alias("sizes"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows"))
    cut = f"cast(sizes + size_before as decimal(27, 0)) * {shards} div cast({total} as decimal(27, 0))"
    found = placed.join(F.broadcast(offsets), "range").select(
        "record", (F.col("rows") + F.col("rows_before")).alias("place"), F.expr(cut).cast("int").alias("shard"))
    firsts = found.groupBy("shard").agg(F.min("place").alias("first"))
    return found.join(F.broadcast(firsts), "shard").select("record.*", "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(df: DataFrame, folder: str, keys: Sequence[str], size: str, shards: int = 8, law: str = "bytes") -> None:
    """Whole records as Parquet, a folder ``shard=<k>`` for each shard, each with the records' slots."""
    sharded(df, keys, size, shards, law).write.partitionBy("shard").parquet(folder)


def document_shards(df: DataFrame, id: str = "doc_id", text: str = "text", shards: int = 8, law: str = "bytes") -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Documents are ordered by the digest of their text and by id, so equal texts are neighbours. A null text is empty for the digest.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(F.col(id).alias("doc_id"), (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"),
                       F.sha2(whole.cast("binary"), 256).alias("digest"))
    return sharded(narrow, ["digest", "doc_id"], "size", shards, law).select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
