"""Exact deduplication with a blocked Bloom filter of repeated digests.

Pass one: every task inserts its digests into a Bloom filter of its own and keeps the
positions that were set once and those set again; the partial filters meet by segment, where
a position set by two rows anywhere goes into the filter of repeated digests. Pass two: rows
whose positions are not all in that filter are alone with their text and pass straight
through; only the others are shuffled and compared by their whole SHA-256.

The filter of repeated digests is sent to every executor. Its size follows the number of rows
up to ``filter_bytes`` and no further: beyond that more rows count as possibly repeated
and are compared exactly, so the result stays the same.

Defined results: a null text is empty; texts are equal when their bytes are. Of equal texts
the row with the largest id stays; a null id is below any other; of rows that repeat id and
text one stays. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bloom import among, without
from .common import documents_of, hex_of, join_groups, landed

BLOCK_BITS = 4096
POSITIONS = 3
BITS_PER_ROW = 24
SEGMENT_BITS = 20


def digests(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row`` (unlike for rows alike) and the 32-byte ``digest`` of each row, landed."""
    docs = documents_of(df, id, text)
    return landed(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")),
        "digests")


def _places(blocks: int):
    """The block of a digest and its positions there."""
    bits = F.xxhash64("digest", F.lit(2))
    return (F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(blocks)).cast("int"),
            F.array(*[F.shiftright(bits, 12 * j).bitwiseAND(BLOCK_BITS - 1).cast("int") for j in range(POSITIONS)]))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions that a task's rows set once and set again, by segment of the filter."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        block = batch.column(0).to_numpy().astype(np.int64)
        places = batch.column(1).values.to_numpy().reshape(batch.num_rows, POSITIONS) + block[:, None] * BLOCK_BITS
        places.sort(axis=1)
        own = np.ones(places.shape, bool)
        own[:, 1:] = places[:, 1:] != places[:, :-1]  # a row that hits a position twice sets it once
        found, times = np.unique(places[own], return_counts=True)
        segment = found >> SEGMENT_BITS
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        ends = np.append(starts[1:], len(found))
        yield pa.record_batch({
            "segment": pa.array(segment[starts], pa.int32()),
            "once": pa.array([found[a:b].astype(np.uint32).tobytes() for a, b in zip(starts, ends)], pa.binary()),
            "again": pa.array([found[a:b][times[a:b] > 1].astype(np.uint32).tobytes() for a, b in zip(starts, ends)], pa.binary())})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the partial filters of each segment; one segment is held at a time."""
    def ended(segment, twice):
        blocks = np.packbits(twice.reshape(-1, BLOCK_BITS), axis=1)
        some = np.flatnonzero(blocks.any(axis=1))
        return pa.record_batch({
            "block": pa.array((some + (segment << SEGMENT_BITS) // BLOCK_BITS).astype(np.int32)),
            "bits": pa.array([blocks[i].tobytes() for i in some], pa.binary())})

    current, seen, twice = None, np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
    for batch in batches:
        for segment, once, again in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if segment != current:
                if current is not None:
                    yield ended(current, twice)
                current = segment
                seen[:], twice[:] = False, False
            places = (np.frombuffer(once, np.uint32) & ((1 << SEGMENT_BITS) - 1)).astype(np.int64)
            twice[places[seen[places]]] = True
            seen[places] = True
            twice[(np.frombuffer(again, np.uint32) & ((1 << SEGMENT_BITS) - 1)).astype(np.int64)] = True
    if current is not None:
        yield ended(current, twice)


def repeated_filter(rows: DataFrame, blocks: int) -> DataFrame:
    """Pass one: ``block`` and ``bits`` of the filter of repeated digests."""
    block, places = _places(blocks)
    parts = rows.select(block.alias("block"), places.alias("places")).mapInArrow(_partial, "segment int, once binary, again binary")
    return (parts.repartition("segment").sortWithinPartitions("segment")
            .mapInArrow(_merge, "block int, bits binary"))


def possibly_repeated(rows: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """Adds ``maybe``: whether all positions of the digest are in the filter."""
    block, places = _places(blocks)
    probed = rows.withColumn("block", block).join(F.broadcast(bits), "block", "left").withColumn("places", places)
    tests = [F.expr(
        f"(shiftright(cast(conv(hex(substring(bits, 1 + shiftright(places[{j}], 3), 1)), 16, 10) as int), 7 - (places[{j}] & 7)) & 1) = 1")
        for j in range(POSITIONS)]
    maybe = F.coalesce(tests[0] & tests[1] & tests[2], F.lit(False))
    return probed.withColumn("maybe", maybe).drop("block", "bits", "places")


def exact_copies(df: DataFrame, id: str = "doc_id", text: str = "text", filter_bytes: int = 64 << 20) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``same_row``.

    ``same_row`` tells that another row has the same id and text.
    """
    rows = digests(df, id, text)
    total = rows.count()
    blocks = 1 << max(0, (min(filter_bytes * 8, max(1, total) * BITS_PER_ROW) // BLOCK_BITS).bit_length())
    blocks = min(blocks, filter_bytes * 8 // BLOCK_BITS)
    probed = possibly_repeated(rows, landed(repeated_filter(rows, blocks), "repeated"), blocks)
    alone = probed.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        hex_of(F.col("digest")).alias("text_sha256"), F.lit(False).alias("same_row"))
    maybe = probed.filter("maybe").select("doc_id", "row", "digest")
    groups = maybe.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
    together = join_groups(maybe, groups, "digest", "group_size", total).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"),
        hex_of(F.col("digest")).alias("text_sha256"), (F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("row") != F.col("stays.row"))).alias("same_row"))
    return alone.unionByName(together)


def drop_copies(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, whole.

    Rows pass where they lie unless a filter of the ids and digests that go knows them.
    """
    verdicts = landed(exact_copies(df, id, text).filter("group_size > 1"), "copies")
    key = lambda i, digest: F.to_json(F.struct(i.alias("i"), digest.alias("d")))
    own = key(F.col(id), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    named = verdicts.withColumn("key", key(F.col("doc_id"), F.col("text_sha256")))
    stays = without(df, own, named.filter("not kept").select("key"))
    twice = named.filter("same_row")
    if twice.isEmpty():
        return stays
    again = among(df, own, twice.select("key")).select(F.struct("*").alias("row"), own.alias("own")).dropDuplicates(["own"]).select("row.*")
    return stays.unionByName(again)
