"""What the operators share: joins with hot keys, columns under safe names, slices of Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sievework.operators import grouping
from sievework import session
from sievework.session import new_folder as shared  # noqa: F401  for the operators

#: Rows of an Arrow batch at most while a table is landed: texts, sets and registers are wide, and a task holds a batch on both sides.
ARROW_ROWS = 2_000
#: Bytes of text that one step of an Arrow task works on at once.
STEP_BYTES = 4 << 20


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """``session.landed`` with Arrow batches of few rows."""
    return session.landed(df, purpose, ARROW_ROWS)


def documents_of(df: DataFrame, id: str, text: str) -> DataFrame:
    """Only the two columns an operator reads, under names no other column clashes with."""
    return df.select(df[id].alias("doc_id"), F.coalesce(df[text], F.lit("")).alias("text"))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, least: int = 1_000) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` on one key; large groups meet their rows where these lie."""
    return grouping.join_groups(rows, groups, [key], size, total, least)


def release() -> None:
    """Give the memory that freed arrays and batches left with the allocators back to the system, as workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``task`` that releases its memory when it ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            release()

    return run


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``size`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A column of strings as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def hex_of(column: Column) -> Column:
    return F.lower(F.hex(column))
