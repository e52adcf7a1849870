"""Pair work in cells of bounded size.

Rows of a bucket are dealt into blocks by a hash of their id, as many as the
bucket's size calls for. A cell is a pair of blocks; a task holds one cell at a
time, at most two blocks of rows, however large the bucket is. A cell returns
summaries (counts, best pairs, a few neighbours per row), never its pairs.

Blocks of larger buckets are written once to the shared folder, and a task reads the two of its cell, so
the disk that pairs take grows with the rows and not with the cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import new_folder

BLOCK_ROWS = 2048


def block_count(rows: Column, block_rows: int = BLOCK_ROWS) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(block_rows))).cast("int")


def part_name(bucket: Sequence[str], block: Column) -> Column:
    """The name of a block of a bucket."""
    return F.md5(F.to_json(F.struct(*bucket, block.alias("_b"))))


def whole_cells(rows: DataFrame, bucket: Sequence[str]) -> DataFrame:
    """Rows of buckets that are one cell each; in it a row is of the low and of the high side."""
    return rows.withColumn("_cell", F.unhex(part_name(bucket, F.lit(0)))).withColumn("_low", F.lit(True)).withColumn("_high", F.lit(True))


class Blocks:
    """Rows dealt into blocks, each a folder of the shared one; ``pairs`` of blocks are its cells.

    ``rows`` have a column ``part``, the name of their block. The rows are written once, for all runs.
    """

    def __init__(self, rows: DataFrame):
        self.folder, self.session = f"{new_folder(rows.sparkSession, 'blocks')}/rows", rows.sparkSession
        self.partitions = int(self.session.conf.get("spark.sql.shuffle.partitions"))
        rows.repartition(self.partitions, F.xxhash64("part")).write.partitionBy("part").parquet(self.folder)

    def run(
        self, pairs: DataFrame, work: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]], schema: StructType | str, tasks: int | None = None,
    ) -> DataFrame:
        """``work`` on each of ``pairs`` (block names ``a`` and ``b``, the same for pairs within a block); it sees further columns of a pair
        as columns of one value. In a cell of two blocks a row is of the low or of the high side, else of both."""
        folder, more = self.folder, [c for c in pairs.columns if c not in ("a", "b")]

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, path = fs.FileSystem.from_uri(folder)

            def block(name: str) -> pa.Table | None:
                at = f"{path}/part={name}"
                if system.get_file_info(at).type == fs.FileType.NotFound:  # no row fell into it
                    return None
                return ds.dataset(at, filesystem=system, format="parquet").to_table().replace_schema_metadata(None)

            def side(table: pa.Table, low: bool, high: bool) -> pa.Table:
                n = table.num_rows
                return table.append_column("_low", pa.array(np.full(n, low))).append_column("_high", pa.array(np.full(n, high)))

            name, own = None, None
            for batch in batches:
                a, b = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in "ab")
                for k in range(batch.num_rows):
                    if a[k] != name:
                        name, own = a[k], block(a[k])
                    other = own if b[k] == name else block(b[k])
                    if own is None or other is None:
                        continue
                    table = side(own, True, True) if b[k] == name else pa.concat_tables([side(own, True, False), side(other, False, True)])
                    for c in more:
                        value = batch.column(batch.schema.get_field_index(c)).slice(k, 1)
                        table = table.append_column(c, value.take(pa.array(np.zeros(table.num_rows, np.int64))))
                    yield from work(table, np.array([0, table.num_rows]))
            yield from _rest(work)

        # some cells of a block follow each other in a task, which so reads the block once
        dealt = pairs.repartition(tasks or self.partitions, F.xxhash64("a", F.pmod(F.xxhash64("b"), F.lit(16)))).sortWithinPartitions("a")
        return dealt.mapInArrow(task, schema)


def pairs_of_blocks(groups: DataFrame, bucket: Sequence[str], blocks: str, keep: Sequence[str] = ()) -> DataFrame:
    """All pairs of the blocks of each bucket, with columns ``keep`` of ``groups``, which has one row per bucket."""
    first = groups.select(*bucket, blocks, *keep, F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)).alias("_a"))
    both = first.select("*", F.explode(F.sequence(F.col("_a"), F.col(blocks) - 1)).alias("_z"))
    return both.select(part_name(bucket, F.col("_a")).alias("a"), part_name(bucket, F.col("_z")).alias("b"), *keep)


class Buckets:
    """Pair work on the rows of buckets: those of one block are shuffled once, larger ones are written as ``Blocks`` once.

    ``groups`` has one row per bucket with its number of blocks in ``blocks``, which ``rows`` have as well.
    """

    def __init__(self, rows: DataFrame, groups: DataFrame, bucket: Sequence[str], blocks: str, id: str):
        self.bucket, self.blocks, self.groups = list(bucket), blocks, groups
        self.small = rows.filter(F.col(blocks) <= 1).drop(blocks)
        block = F.pmod(F.xxhash64(id), F.col(blocks)).cast("int")
        self.large = None
        cells = groups.filter(F.col(blocks) > 1).agg(F.sum(F.col(blocks).cast("long") * (F.col(blocks) + 1) / 2)).first()[0]
        if cells:
            self.large = Blocks(rows.filter(F.col(blocks) > 1).withColumn("part", part_name(bucket, block)).drop(blocks))
            # cells take unlike times, so a few tasks more share them out more evenly
            self.tasks = self.large.partitions * max(1, min(4, int(cells) // (8 * self.large.partitions)))

    def run(self, work: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]], schema: StructType | str, more: DataFrame | None = None) -> DataFrame:
        """``work`` on every cell; ``more`` has one row per bucket that takes part, and columns that ``work`` sees."""
        keep = [] if more is None else [c for c in more.columns if c not in self.bucket]
        small, groups = self.small, self.groups
        if more is not None:
            named = more.select(*[F.col(c).alias(f"_n_{c}") for c in self.bucket], *keep)
            same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in self.bucket])
            small, groups = (df.join(named, same).drop(*[f"_n_{c}" for c in self.bucket]) for df in (small, groups))
        found = run_cells(whole_cells(small, self.bucket), work, schema)
        if self.large is None:
            return found
        pairs = pairs_of_blocks(groups.filter(F.col(self.blocks) > 1), self.bucket, self.blocks, keep)
        return found.unionByName(self.large.run(pairs, work, schema, self.tasks))


def run_cells(
    cells: DataFrame, work: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]], schema: StructType | str,
) -> DataFrame:
    """Apply ``work`` to runs of whole cells: their rows and the bounds between them."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        open_cell = None
        for batch in batches:
            runs = pc.run_end_encode(batch.column(batch.schema.get_field_index("_cell")))
            ends, names = runs.run_ends.to_pylist(), runs.values.to_pylist()
            if not ends:
                continue
            if held and names == [open_cell]:
                held.append(batch)
                continue
            before = sum(b.num_rows for b in held)
            bounds = [0, *[before + e for e in ends[:-1]]]
            if held and names[0] != open_cell:
                bounds.insert(1, before)
            last = ends[-2] if len(ends) > 1 else 0
            if bounds[-1] > 0:
                yield from work(pa.Table.from_batches([*held, batch.slice(0, last)]), np.array(bounds))
            held, open_cell = [batch.slice(last)], names[-1]
        if held:
            table = pa.Table.from_batches(held)
            yield from work(table, np.array([0, table.num_rows]))
        yield from _rest(work)

    # A fixed number of partitions: cells are costly for their size, so they must
    # not be packed together by bytes. They are dealt by a hash of the name: a shuffle by the name itself is
    # left out behind a join on it, and that join may yet become a broadcast that leaves the rows of a cell apart.
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, F.xxhash64("_cell")).sortWithinPartitions("_cell").mapInArrow(task, schema)


def each_cell(work: Callable[[pa.Table], Iterable[pa.RecordBatch]]) -> Callable:
    """``work`` on one cell at a time."""
    def run(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:]):
            yield from work(table.slice(start, end - start))

    return run


class Totals:
    """Work whose results over the cells of a task are added up by bucket and leave it once.

    ``add`` counts a cell into the state of its bucket, which is ``begin`` of its first cell; ``out`` makes the rows of a state from
    the values of the bucket's columns ``keys``. States of more than ``most`` buckets leave early.
    """

    def __init__(self, keys: Sequence[str], begin: Callable, add: Callable, out: Callable, most: int = 16):
        self.keys, self.begin, self.add, self.out, self.most, self.states = list(keys), begin, add, out, most, {}

    def __call__(self, table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:]):
            cell = table.slice(start, end - start)
            name = tuple(cell[k][0].as_py() for k in self.keys)
            if name not in self.states:
                if len(self.states) >= self.most:
                    yield from self.rest()
                self.states[name] = self.begin(cell), [cell[k][0] for k in self.keys]
            self.add(self.states[name][0], cell)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for state, labels in self.states.values():
            yield from self.out(state, labels)
        self.states.clear()


def _rest(work: Callable) -> Iterable[pa.RecordBatch]:
    """What the work still holds at the end of its task; a task has a copy of its own."""
    return work.rest() if isinstance(work, Totals) else ()


# ---- task-side views of a cell ----------------------------------------------

def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two sides and whether they are the same block."""
    low = np.flatnonzero(table["_low"].to_numpy())
    high = np.flatnonzero(table["_high"].to_numpy())
    return low, high, len(low) == len(high) == table.num_rows


def dense(table: pa.Table, name: str) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        table.num_rows, -1)


def products(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """Products in strips of rows: first row, values, and which of them count.
    Within one block each pair counts once, above the diagonal."""
    strip = max(1, 1_000_000 // max(1, len(right)))
    for start in range(0, len(left), strip):
        values = left[start:start + strip] @ right.T
        counts = np.arange(len(right)) > np.arange(start, start + len(values))[:, None] if same else None
        yield start, values, counts


#: A term is multiplied densely when more than one pair of rows in so many shares it, else entry by entry.
SHARED_BY = 200
#: Products of sparse entries, and values of a strip, at once: they stay in a core's cache.
ENTRIES_AT_ONCE, VALUES_AT_ONCE = 1 << 15, 1 << 18


class SharedTerms:
    """Products of sparse rows with those of one side, ``high``.

    The entries of a row follow each other from ``starts``: a small number of their term each and, but for sets, a weight.
    Terms that many pairs share are columns of dense matrices; of the others each entry meets those of the other side with its
    term, so the work follows the pairs that share a term and not the number of terms.
    """

    def __init__(self, starts: np.ndarray, lengths: np.ndarray, key: np.ndarray, weight: np.ndarray | None, high: np.ndarray, dtype: type = np.float64):
        terms = int(key.max()) + 1 if len(key) else 1
        self.starts, self.lengths, self.dtype, self.wide = starts, lengths, dtype, len(high)
        self.key = key.astype(np.uint16) if terms <= 1 << 16 else key
        self.weight = None if weight is None else weight.astype(dtype, copy=False)
        at, k, w = self._entries(high)
        seen = np.bincount(k, minlength=terms)
        self.many = np.bincount(self.key, minlength=terms) * seen * SHARED_BY > len(lengths) * len(high)
        self.number = np.cumsum(self.many) - 1
        self.high = self._dense(len(high), at, k, w)
        self.rare = ~self.many & (seen > 0)
        use = np.flatnonzero(self.rare[k])
        use = use[np.argsort(k[use], kind="stable")]
        self.met = at[use]
        self.met_weight = None if w is None else w[use]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(k[use], minlength=terms))])
        self.ones, self.work = np.ones(0, dtype), 0

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        n = self.lengths[rows]
        before = np.cumsum(n) - n
        entry = np.repeat(self.starts[rows] - before, n) + np.arange(int(n.sum()))
        return np.repeat(np.arange(len(rows)), n), self.key[entry], None if self.weight is None else self.weight[entry]

    def _dense(self, rows: int, at: np.ndarray, key: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
        use, matrix = self.many[key], np.zeros((rows, int(self.many.sum())), self.dtype)
        matrix[at[use], self.number[key[use]]] = 1 if weight is None else weight[use]
        return matrix

    def products(self, low: np.ndarray) -> np.ndarray:
        """All products of some rows with those of the side; ``work`` counts the multiplications."""
        out = np.empty((len(low), self.wide), self.dtype)
        strip = max(1, VALUES_AT_ONCE // max(1, self.wide))
        for start in range(0, len(low), strip):
            self._strip(low[start:start + strip], out[start:start + strip])
        return out

    def _strip(self, low: np.ndarray, values: np.ndarray) -> None:
        at, key, weight = self._entries(low)
        np.matmul(self._dense(len(low), at, key, weight), self.high.T, out=values)
        flat, use = values.reshape(-1), self.rare[key]
        at, key = at[use], key[use]
        weight = None if weight is None else weight[use]
        first = self.first[key]
        meets = self.first[key.astype(np.int64) + 1] - first
        ends, here = np.cumsum(meets), 0
        self.work += values.size * self.high.shape[1] + int(meets.sum())
        while here < len(at):
            to = max(here + 1, int(np.searchsorted(ends, (ends[here - 1] if here else 0) + ENTRIES_AT_ONCE, side="right")))
            n = meets[here:to]
            before = ends[here:to] - n
            met = np.repeat(first[here:to] - before + before[0], n) + np.arange(int(n.sum()))
            if weight is None:
                if len(met) > len(self.ones):
                    self.ones = np.ones(len(met), self.dtype)
                value = self.ones[:len(met)]
            else:
                value = np.repeat(weight[here:to], n) * self.met_weight[met]
            np.add.at(flat, np.repeat(at[here:to] * self.wide, n) + self.met[met], value)
            here = to


def sparse_products(table: pa.Table, places: str, weights: str) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """``products`` of the two sides of a cell whose rows are lists of different term keys and of their weights."""
    low, high, same = sides(table)
    lists = table[places].combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    key = lists.flatten().to_numpy(zero_copy_only=False)
    if len(key) and (key.min() < 0 or key.max() >= 1 << 16):
        key = np.unique(key, return_inverse=True)[1]
    weight = table[weights].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    shared = SharedTerms(np.cumsum(lengths) - lengths, lengths, key, weight, high)
    strip = max(1, VALUES_AT_ONCE // max(1, len(high)))
    for start in range(0, len(low), strip):
        values = shared.products(low[start:start + strip])
        counts = np.arange(len(high)) > np.arange(start, start + len(values))[:, None] if same else None
        yield start, values, counts


#: Tokens of a set looked up in the time in which one more pair is counted by products.
SINGLE = 16
#: Meetings of rare tokens for each pair of rows up to which only pairs that share one are looked at.
FEW_MEET = 0.4


class TokenSets:
    """Sets of tokens of a cell: exact similarities of the pairs that sizes, positions and bins leave possible.

    Two sets beyond the threshold share one of the rarest tokens of each, so where few pairs share such a token only these are looked at.
    Tokens fall into bins by their hash. Two sets share at most the sum of the lesser bin counts; and where a token of the
    rarest-first order brought them together first, at most that one and what the shorter rest holds. Only the pairs whose
    bound reaches the threshold are counted, singly or, when there are many, by products over the terms that pairs share.
    """

    def __init__(self, table: pa.Table, tokens: str, size: str, rest: str, threshold: float, bins: int = 64):
        keys = table[tokens].combine_chunks()
        self.lengths = pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.n, self.rest = table[size].to_numpy().astype(np.int64), table[rest].to_numpy().astype(np.int64)
        self.threshold, flat = threshold, keys.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(table.num_rows), self.lengths)
        counts = np.bincount(row * bins + (flat & (bins - 1)), minlength=table.num_rows * bins).reshape(-1, bins)
        self.bins = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))
        wide = counts.reshape(-1, bins // 4, 4).sum(axis=2)
        self.few = wide.astype(np.min_scalar_type(int(wide.max(initial=0))))
        self.column = pc.dictionary_encode(pa.array(flat)).indices.to_numpy().astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.mark = np.zeros(int(self.column.max(initial=-1)) + 1, bool)
        self.side, self.shared, self.blunt = None, None, False
        self.prefixes = self._prefixes(row)

    def _prefixes(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and tokens of the rarest tokens of each set, among which any two similar sets share one.

        Tokens are ranked by the rows of the cell that hold them, in steps of a fifth; a set takes whole ranks until
        it has the tokens it needs. Tokens of one row bring no pair.
        """
        seen = np.bincount(self.column)
        rank = np.ceil(4 * np.log2(np.maximum(seen, 1))).astype(np.uint8)
        ranks, level = int(rank.max(initial=0)) + 1, rank[self.column]
        upto = np.bincount(row * ranks + level, minlength=len(self.lengths) * ranks).reshape(-1, ranks).cumsum(axis=1)
        need = self.lengths - np.ceil(np.round(self.lengths * self.threshold, 9)) + 1
        last = (upto >= np.minimum(need, self.lengths)[:, None]).argmax(axis=1)
        use = np.flatnonzero((level <= last[row]) & (seen[self.column] > 1))
        lengths = np.bincount(row[use], minlength=len(self.lengths))
        return np.cumsum(lengths) - lengths, lengths, self.column[use]

    def near(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pairs of rows that are more similar than the threshold, with their similarities."""
        starts, lengths, tokens = self.prefixes
        sides = []
        for rows in (a, b):
            n = lengths[rows]
            before = np.cumsum(n) - n
            sides.append((np.repeat(np.arange(len(rows)), n), tokens[np.repeat(starts[rows] - before, n) + np.arange(int(n.sum()))]))
        (own, own_token), (other, other_token) = sides
        order = np.argsort(other_token, kind="stable")
        other, first = other[order], np.concatenate([[0], np.cumsum(np.bincount(other_token, minlength=len(self.mark)))])
        meets = first[own_token + 1] - first[own_token]
        ends = np.cumsum(meets)
        if len(ends) and ends[-1] > FEW_MEET * len(a) * len(b):  # too many pairs share a rare token
            strip = max(1, 1_000_000 // len(b))
            for start in range(0, len(a), strip):
                rows = a[start:start + strip]
                sim = self.similarities(rows, b)
                r, c = np.nonzero(sim > self.threshold)
                yield rows[r], b[c], sim[r, c]
            return
        at = 0
        while at < len(own):  # whole rows, so a pair comes once
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 18), side="right")))
            to = int(np.searchsorted(own, own[to - 1], side="right"))
            n = meets[at:to]
            before = np.cumsum(n) - n
            pairs = np.unique(np.repeat(own[at:to], n) * len(b) + other[np.repeat(first[own_token[at:to]] - before, n) + np.arange(int(n.sum()))])
            yield self._above(a[pairs // len(b)], b[pairs % len(b)])
            at = to

    def _above(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of some pairs, in the order of ``a``, that are more similar than the threshold."""
        na, nb, t = self.n[a], self.n[b], self.threshold
        need = t / (1 + t) * (na + nb) - 1e-6
        ok = (np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-6) & (1 + np.minimum(self.rest[a], self.rest[b]) >= need)
        for bins in (self.few, self.bins):
            at = np.flatnonzero(ok)
            for some in np.array_split(at, 1 + len(at) // 100_000):
                ok[some] = np.minimum(bins[a[some]], bins[b[some]]).sum(axis=1, dtype=np.int64) >= need[some]
        a, b = a[ok], b[ok]
        sim, total = np.zeros(len(a)), self.n[a] + self.n[b]
        bounds = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1], [True]])) if len(a) else np.zeros(1, np.int64)
        for start, end in zip(bounds[:-1], bounds[1:]):
            common = self._common(a[start], b[start:end])
            sim[start:end] = common / (total[start:end] - common)
        use = sim > t
        return a[use], b[use], sim[use]

    def _common(self, row: int, others: np.ndarray) -> np.ndarray:
        """Common tokens of a set with others, one by one."""
        own = self.column[self.starts[row]:self.starts[row] + self.lengths[row]]
        self.mark[own] = True
        out = np.zeros(len(others), np.int64)
        for some in np.array_split(np.arange(len(others)), 1 + int(self.lengths[others].sum()) // 4_000_000):
            sizes = self.lengths[others[some]]
            before = np.cumsum(sizes) - sizes
            tokens = self.column[np.repeat(self.starts[others[some]] - before, sizes) + np.arange(int(sizes.sum()))]
            out[some] = np.add.reduceat(self.mark[tokens], before, dtype=np.int64)
        self.mark[own] = False
        return out

    def possible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of rows may be more similar than the threshold."""
        na, nb, t = self.n[a][:, None], self.n[b][None, :], self.threshold
        need = t / (1 + t) * (na + nb) - 1e-6
        ok = (np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-6) & (1 + np.minimum(self.rest[a][:, None], self.rest[b][None, :]) >= need)
        for bins in () if self.blunt else (self.few, self.bins):  # a few wide bins rule out most pairs, and the rest is looked at singly
            possible = np.count_nonzero(ok)
            if bins is self.bins and 2 * possible > ok.size:  # counting them all is as cheap, for the next rows too
                self.blunt = True
                break
            if 4 * possible < ok.size:
                for i in np.flatnonzero(ok.any(1)):
                    at = np.flatnonzero(ok[i])
                    ok[i, at] = np.minimum(bins[a[i]], bins[b[at]]).sum(axis=1, dtype=np.int64) >= need[i, at]
            else:
                both = np.zeros(ok.shape, np.uint16 if int(self.n.max()) < 1 << 16 else np.int64)
                for g in range(bins.shape[1]):
                    both += np.minimum(bins[a, g][:, None], bins[b, g][None, :])
                ok &= both >= need
        return ok

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common tokens of all pairs; what ``b`` needs is kept for the next rows."""
        if self.side is None or not np.array_equal(self.side, b):
            self.side, self.shared = b, SharedTerms(self.starts, self.lengths, self.column, None, b, np.float32)
        return self.shared.products(a)

    def similarities(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Jaccard similarities of pairs of rows; 0 for pairs that cannot pass the threshold."""
        ok = self.possible(a, b)
        total = self.n[a][:, None] + self.n[b][None, :]
        if np.count_nonzero(ok) * self.lengths[b].mean() > SINGLE * ok.size:
            both = self.products(a, b)
            return np.where(ok, both / np.maximum(total - both, 1), 0.0)
        out = np.zeros(ok.shape)
        for i in np.flatnonzero(ok.any(1)):
            at = np.flatnonzero(ok[i])
            common = self._common(a[i], b[at])
            out[i, at] = common / (total[i, at] - common)
        return out
