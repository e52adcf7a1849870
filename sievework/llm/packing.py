"""Packing documents into sequences of bounded length by linear grouping.

Documents of one length are interchangeable, so the plan is made from the histogram of lengths alone,
at most one number per possible length whatever the corpus. Lengths above an eighth of a sequence are
dealt in order into groups of equal cardinality and rounded up to the largest of their group; the
configurations of these few sizes are optimised by column generation (simplex steps, each new
configuration from a knapsack), whole multiples are taken, actual lengths take the places of rounded
ones, and what is left over goes with the small lengths, longest first, to the sequence with the least
room that suffices. Several numbers of groups are tried and the shortest plan stays.

Documents are encoded once where they lie; their rank among those of their length is a rank in their
partition plus the count of earlier partitions. A plan is a table of runs of places by length, bounded
like the histogram; every task looks its documents up there. No token is shuffled.

Defined results: a null text is empty and has its end id only; documents longer than a sequence are
cut into full pieces and a rest; repeated rows are packed each; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import documents_of, landed, sliced, tidy
from .tokens import Encoder

#: Chunks a task keeps the ids of, few enough to pack beside other stages' workers.
KEPT = 120_000
CAPACITY = 4096
LARGE = 1 / 8
GROUPS = (8, 16, 32)
_RANK_BITS = 48


# ---- the plan, from a histogram of lengths --------------------------------------

def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes of most worth that fits, by the number of items and the room."""
    value, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        new, pick = value.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            with_it = value[:-size] + worth[i]
            better = with_it > new[size:] + 1e-12
            new[size:][better] = with_it[better]
            pick[size:][better] = i
        picks.append(pick)
        value = new
    counts, room = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        i = pick[room]
        if i >= 0:
            counts[i] += 1
            room -= sizes[i]
    return float(value[capacity]), counts


def configurations(sizes: np.ndarray, wanted: np.ndarray, capacity: int, steps: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations of few sizes and how often each is used, rounded down from the least number of sequences in fractions."""
    columns = np.diag((capacity // sizes).astype(float))
    for _ in range(steps):
        used = np.linalg.solve(columns, wanted)
        worth = np.linalg.solve(columns.T, np.ones(len(sizes)))
        best, new = best_configuration(sizes, worth, capacity)
        if best <= 1 + 1e-9:
            break
        change = np.linalg.solve(columns, new)
        ratio = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        columns[:, int(np.argmin(ratio))] = new
    used = np.linalg.solve(columns, wanted)
    return [(columns[:, i].astype(int), int(n + 1e-6)) for i, n in enumerate(used) if n + 1e-6 >= 1]


class Bins:
    """Runs of sequences filled alike, by the room they have left.

    A run is its number of sequences and a chain of (earlier chain, length, items, offset).
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: list[list] = [[] for _ in range(capacity + 1)]
        self.some = np.zeros(capacity + 1, bool)

    def put(self, n: int, room: int, chain) -> None:
        if n:
            self.runs[room].append((n, chain))
            self.some[room] = True

    def best_fit(self, length: int, count: int) -> None:
        """Place items of one length, each where the least room suffices."""
        while count:
            room = length + int(self.some[length:].argmax())
            if room <= self.capacity and self.some[room]:
                n, chain = self.runs[room].pop()
                self.some[room] = bool(self.runs[room])
            else:
                room, n, chain = self.capacity, count, None
            each = min(room // length, count)
            filled = min(n, count // each)
            self.put(filled, room - each * length, (chain, length, each, self.capacity - room))
            if chain is not None:
                self.put(n - filled, room, chain)
            count -= filled * each

    def total(self) -> int:
        return sum(n for runs in self.runs for n, _ in runs)


def grouped(lengths: list[int], counts: list[int], groups: int) -> list[list[list[int]]]:
    """Lengths in falling order dealt into groups of equal cardinality: runs of [length, count]."""
    total, out, filled = sum(counts), [[]], 0
    for length, count in zip(lengths, counts):
        while count:
            room = -(-total * len(out) // groups) - filled
            if room <= 0:
                out.append([])
                continue
            take = min(room, count)
            out[-1].append([length, take])
            filled, count = filled + take, count - take
    return [g for g in out if g]


def substitute(bins: Bins, config: np.ndarray, copies: int, groups: list[list[list[int]]]) -> None:
    """Put actual lengths of the groups, longest first, in place of the rounded ones of a configuration."""
    parts = [(i, int(k)) for i, k in enumerate(config) if k]
    while copies:
        alike = min((groups[i][0][1] // k if groups[i] else copies) for i, k in parts)
        step, chain, used = max(1, min(copies, alike)), None, 0
        for i, k in parts:
            while k and groups[i]:
                run = groups[i][0]
                each = min(k, run[1] // step)
                if each:
                    chain = (chain, run[0], each, used)
                    used += each * run[0]
                    run[1] -= each * step
                    k -= each
                if run[1] == 0:
                    groups[i].pop(0)
                elif not each:
                    break
        if chain is None:
            return
        bins.put(step, bins.capacity - used, chain)
        copies -= step


def plan(histogram: dict[int, int], capacity: int = CAPACITY, group_counts: tuple[int, ...] = GROUPS) -> Bins:
    """The shortest of the plans for the given numbers of groups; few different lengths are also tried as they are."""
    full = histogram.get(capacity, 0)
    order = sorted((n for n in histogram if 0 < n < capacity), reverse=True)
    large = [n for n in order if n > capacity * LARGE]
    best = None
    for number in (*group_counts, 0) if len(large) <= max(group_counts) else group_counts:
        bins, rest = Bins(capacity), {n: histogram[n] for n in order}
        bins.put(full, 0, (None, capacity, 1, 0))
        if large:
            groups = grouped(large, [histogram[n] for n in large], number) if number else [[[n, histogram[n]]] for n in large]
            rounded: dict[int, list] = {}
            for g in groups:  # groups with the same largest length are one size
                rounded.setdefault(g[0][0], []).extend(g)
            sizes = np.array(list(rounded))
            wanted = np.array([sum(c for _, c in g) for g in rounded.values()], float)
            left = list(rounded.values())
            for config, copies in configurations(sizes, wanted, capacity):
                substitute(bins, config, copies, left)
            rest.update(dict.fromkeys(large, 0))
            for g in left:
                for n, c in g:
                    rest[n] += c
        for n in order:
            bins.best_fit(n, rest[n])
        if best is None or bins.total() < best.total():
            best = bins
    return best


def places(bins: Bins) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places sorted by length and first rank: that key, items per sequence, first sequence, offset."""
    filled: dict[int, int] = {}
    rows, base = [], 0
    for runs in bins.runs:
        for n, chain in runs:
            while chain is not None:
                chain, length, each, offset = chain
                first = filled.get(length, 0)
                filled[length] = first + n * each
                rows.append(((length << _RANK_BITS) + first, each, base, offset))
            base += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


# ---- the documents ----------------------------------------------------------------

def pieces(df: DataFrame, tokenizer: str, end: int, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and the ``part`` and ``rank`` of a piece among those of its length there."""
    docs = documents_of(df, id, text)
    kind = docs.schema["doc_id"].dataType

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, tail = Encoder(tokenizer, False, KEPT), np.zeros(capacity + 1, np.int64), end.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        for batch in sliced(batches):
            at, piece, start, length, crc, rank = [], [], [], [], [], []
            for row, ids in enumerate(encode(batch.column(1).to_pylist())):
                ids += tail
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    data = ids[a:a + 4 * capacity]
                    n = len(data) // 4
                    at.append(row)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(n)
                    crc.append(crc32(data))
                    rank.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()), pa.array([part] * len(at), pa.int32()), pa.array(rank, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return docs.mapInArrow(tidy(task), f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, rank long")


def pack(df: DataFrame, tokenizer: str, end: int, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    rows = landed(pieces(df, tokenizer, end, id, text, capacity), "pieces")
    counts = rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    key, each, base, offset = places(plan(histogram, capacity))
    before = counts.withColumn("before", F.expr("sum(n) over (partition by length order by part) - n")).drop("n")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            run = np.searchsorted(key, (length << _RANK_BITS) + rank, side="right") - 1
            number = rank - (key[run] & ((1 << _RANK_BITS) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(base[run] + number // each[run]), pa.array(offset[run] + number % each[run] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = rows.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(tidy(task), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(packed: DataFrame, df: DataFrame, tokenizer: str, end: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids``; each is one group of at most a sequence's length.

    Ids of documents must be unique here.
    """
    docs = documents_of(df, id, text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, False)
        for batch in sliced(batches):
            ids = [np.append(np.frombuffer(x, np.int32), np.int32(end)) for x in encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    encoded = docs.mapInArrow(task, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")
    parts = packed.join(encoded, "doc_id").select("sequence_id", "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids"))
    ordered = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return ordered.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
