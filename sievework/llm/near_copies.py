"""Near-duplicate detection with HyperMinHash registers.

Every shingle falls into one of 192 buckets by its hash; a bucket keeps its least second hash
as a count of leading zeros and ten mantissa bits. Six registers make a band; texts that share a
band meet. Of a band's texts the first is compared with all others: the share of equal registers
less the expected chance collisions estimates the similarity, pairs within five deviations of the
threshold are verified on their full shingle sets. Where a band's texts are not in one component after that,
those outside its largest component are compared with all its texts of other components, in cells of two
blocks. A first pass sends only registers through the cells and finds the texts with a likely partner under another label; a
second one sends the sets of these, and its cells return at most one link per part they join. Bands
that a crowd meets in again and again under one first text are one there, so its texts are sent once and not once a band. So no link that joins components is lost
within a band, and no group returns all its pairs. There are as many bands as it takes that a pair at the threshold shares
none with a probability of at most 3e-7: 32 at 85 percent, 39 at 80.

Texts with the same set are one text throughout; the texts' sets are read again only for those that
are compared.

Defined results: a null text is empty; a text without words has no shingles, is linked with
nothing and is kept. Links join rows, so rows that repeat an id are judged by their texts;
``component_id`` is the least id of the component, null only if all are. ``kept`` marks the rows with
that id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bloom import among, without
from .common import byte_texts, documents_of, join_groups, landed, sliced, tidy
from .components import components
from .shingles import _FACTOR, mix, shingle_sets

REGISTERS = 192
#: The most that a pair at the threshold may share no band.
MISSED = 3e-7
MANTISSA = 10
DEVIATIONS = 5
#: Texts that one copy of a band's first text is compared with.
STAR_BLOCK = 128
#: Texts of a cell: outside the largest component, and of the whole band.
BLOCK, BAND_BLOCK = 1024, 1024
#: Times these texts where only registers are sent.
NARROW = 4
WIDTH = 5
#: Rows of a batch that are unpacked at once.
RUN_ROWS = 256
#: Expected share of registers that agree by chance, times two to the mantissa's bits, for sets of one size.
CHANCE = 0.1699


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 192 registers per set; 0 is an empty bucket."""
    least = np.full(len(sets) * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    at = np.repeat(np.arange(len(sets)) * REGISTERS, [len(s) for s in sets]) + (every % np.uint64(REGISTERS)).astype(np.int64)
    np.minimum.at(least, at, mix(every * _FACTOR[7]) >> np.uint64(1))
    some = least < np.uint64(1 << 63)
    zeros = np.where(some, 63 - np.frexp(np.maximum(least, np.uint64(1)).astype(np.float64))[1], 0).clip(0, 61)
    rest = ((least << (zeros + 2).astype(np.uint64)) >> np.uint64(64 - MANTISSA)).astype(np.int64)
    return np.where(some, 1 + (zeros << MANTISSA) + rest, 0).astype(np.uint16).reshape(len(sets), REGISTERS)


def estimate(one: np.ndarray, many: np.ndarray, n: int, ns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarities of one row of registers with many, and the registers they rest on."""
    both = (many > 0) & (one > 0)
    same = ((many == one) & both).sum(axis=1)
    used = ((many > 0) | (one > 0)).sum(axis=1)
    chance = CHANCE / (1 << MANTISSA) * 4.0 * n * ns / np.square(n + ns.astype(np.float64))
    return np.maximum(0.0, same - chance * (both.sum(axis=1) - same)) / np.maximum(used, 1), used


def likely(one: np.ndarray, many: np.ndarray, n: int, ns: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs may reach the threshold, by size and by estimate."""
    close = np.minimum(n, ns) >= threshold * np.maximum(n, ns) - 1e-9
    similar, used = estimate(one, many, n, ns)
    margin = DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    return close & (similar >= threshold - margin)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges the two runs
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def set_digest(s: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    return b"".join(int((mix(s ^ _FACTOR[k])).sum(dtype=np.uint64) if len(s) else 0).to_bytes(8, "big") for k in (8, 9))


def band_starts(percent: int) -> np.ndarray:
    """The first registers of the fewest bands, as even as can be, that miss few enough pairs at the threshold."""
    for bands in range(1, REGISTERS + 1):
        starts = np.arange(bands) * REGISTERS // bands
        if np.prod(1 - (percent / 100) ** np.diff(np.append(starts, REGISTERS)).astype(float)) <= MISSED:
            break
    return starts


def _signatures(percent: int) -> Callable:
    starts = band_starts(percent)
    within = np.arange(REGISTERS) - np.repeat(starts, np.diff(np.append(starts, REGISTERS)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = shingle_sets(byte_texts(batch), WIDTH)
            rows = registers(sets)
            keys = np.add.reduceat(rows.astype(np.uint64) * _FACTOR[within], starts, axis=1)
            keys = mix(keys + np.arange(len(starts), dtype=np.uint64) * _FACTOR[10]).view(np.int64)
            full = np.logical_or.reduceat(rows > 0, starts, axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_digest(s) for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([k[f] for k, f in zip(keys, full)], pa.list_(pa.int64()))],
                names=["doc_id", "row", "n_shingles", "set", "registers", "keys"])

    return task


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sets = shingle_sets(byte_texts(batch), WIDTH)
        yield pa.record_batch([pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                              names=["set", "members"])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first columns; a run is at most two blocks of rows."""
    current, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, RUN_ROWS):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, RUN_ROWS).columns)):
                if row[:keys] != current:
                    if rows:
                        yield current, rows
                    current, rows = row[:keys], []
                rows.append(row[keys:])
    if rows:
        yield current, rows


def star_pairs(pairs: DataFrame, payload: DataFrame, test: Callable[[tuple, list[tuple]], np.ndarray], columns: list[str]) -> DataFrame:
    """The pairs ``pivot``, ``node`` that pass ``test(pivot's columns, columns of the others)``.

    A pivot's pairs are dealt into blocks, each of which gets a copy of the pivot's columns.
    """
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR_BLOCK)).cast("int").alias("blocks"))
    large = sizes.filter("blocks > 1")
    dealt = pairs.join(F.broadcast(large), "pivot", "left") if large.limit(100_001).count() <= 100_000 else pairs.join(large, "pivot", "left")
    dealt = dealt.select("pivot", "node", F.when(F.col("blocks").isNull(), 0).otherwise(
        F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int").alias("block"))
    others = dealt.join(payload, "node").select("pivot", "block", F.lit(1).alias("side"), "node", *columns)
    firsts = sizes.select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(
        payload.withColumnRenamed("node", "pivot"), "pivot").select("pivot", "block", F.lit(0).alias("side"), F.col("pivot").alias("node"), *columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pivot, _), rows in _runs(batches, 2):
            if rows[0][0] == 0 and len(rows) > 1:
                passed = [r[1] for r, ok in zip(rows[1:], test(rows[0][2:], [r[2:] for r in rows[1:]])) if ok]
                yield pa.record_batch([pa.array([pivot] * len(passed), pa.int64()), pa.array(passed, pa.int64())], names=["pivot", "node"])

    return (firsts.unionByName(others).repartition("pivot", "block").sortWithinPartitions("pivot", "block", "side")
            .mapInArrow(tidy(task), "pivot long, node long"))


def _cell_partners(percent: int) -> Callable:
    """Texts of a cell with a likely partner under another label, told by registers and sizes alone."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, _, _), rows in _runs(batches, 3):
            side, node, label, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
            regs = np.stack([np.frombuffer(r[4], np.uint16) for r in rows])
            all_, met = np.flatnonzero(side != 0), np.zeros(len(rows), bool)
            for i in np.flatnonzero(side != 1):
                other = all_[label[all_] != label[i]]
                other = other[likely(regs[i], regs[other], int(n[i]), n[other], percent / 100)]
                met[other] = True
                met[i] |= len(other) > 0
            if met.any():
                found = np.unique(node[met])
                yield pa.record_batch([pa.array([key] * len(found), pa.int64()), pa.array(found)], names=["key", "node"])

    return task


def _cell_links(percent: int) -> Callable:
    """Links of a cell from its texts of side 0 to those of side 1 under other labels, at most one per pair of parts that it joins.

    A text of side 2 is on both, which saves its copy where a band is one cell.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, 3):
            side, node, label, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
            regs = np.stack([np.frombuffer(r[4], np.uint16) for r in rows])
            some, all_ = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            sets = [np.frombuffer(r[5], np.uint64) for r in rows]
            sizes = np.array([len(x) for x in sets])
            starts = np.cumsum(sizes) - sizes
            number = np.unique(np.concatenate(sets), return_inverse=True)[1]
            mark = np.zeros(len(number) + 1, bool)
            found = []
            for i in some:
                other = all_[label[all_] != label[i]]
                other = other[likely(regs[i], regs[other], int(n[i]), n[other], percent / 100)]
                if len(other) == 0:
                    continue
                own = number[starts[i]:starts[i] + sizes[i]]
                mark[own] = True
                within = np.cumsum(sizes[other]) - sizes[other]
                shingles = number[np.repeat(starts[other] - within, sizes[other]) + np.arange(int(sizes[other].sum()))]
                common = np.add.reduceat(mark[shingles], within, dtype=np.int64)
                mark[own] = False
                for j in other[100 * common >= percent * (sizes[i] + sizes[other] - common)]:
                    if label[j] != label[i]:
                        found.append((node[i], node[j]))
                        label[label == label[j]] = label[i]
            if found:
                yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["u", "v"])

    return task


def near_copies(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    docs = documents_of(df, id, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = landed(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        tidy(_signatures(percent)), f"doc_id {kind}, row long, n_shingles long, set binary, registers binary, keys array<long>"), "signatures")
    total = rows.count()
    some = rows.filter("n_shingles > 0")
    nodes = landed(some.groupBy("set").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size"), F.min("row").alias("node"),
        F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.first("keys").alias("keys")), "nodes")

    bands = nodes.select("node", F.col("n_shingles").alias("width"), F.explode("keys").alias("key"))
    buckets = bands.groupBy("key").agg(F.min(F.struct("node", "width")).alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = landed(join_groups(bands, buckets, "key", "n", len(band_starts(percent)) * total), "members")
    # a set shares at most the smaller size of two, so pairs of unlike sizes send no registers
    alike = 100 * F.least("width", "pivot.width") >= percent * F.greatest("width", "pivot.width")
    pairs = members.filter(alike & (F.col("node") != F.col("pivot.node"))).select(F.col("pivot.node").alias("pivot"), "node").distinct()

    share = percent / 100
    def by_estimate(first: tuple, others: list[tuple]) -> np.ndarray:
        many = np.stack([np.frombuffer(o[1], np.uint16) for o in others])
        return likely(np.frombuffer(first[1], np.uint16), many, first[0], np.array([o[0] for o in others], np.int64), share)

    def by_sets(first: tuple, others: list[tuple]) -> np.ndarray:
        own = np.frombuffer(first[0], np.uint64)
        return np.array([linked(own, np.frombuffer(o[0], np.uint64), percent) for o in others])

    def sets_of(wanted: DataFrame) -> DataFrame:
        """``node``, ``n_shingles``, ``registers`` and ``members`` of the wanted nodes, from their texts."""
        named = landed(nodes.drop("keys").join(wanted, "node", "left_semi"), "wanted")
        sets = among(docs, F.col("doc_id"), named.select("first_id")).select("text").mapInArrow(tidy(_sets), "set binary, members binary")
        once = sets.join(named.select("set"), "set", "left_semi").groupBy("set").agg(F.first("members").alias("members"))
        return landed(named.join(once, "set").select("node", "n_shingles", "registers", "members"), "sets")

    close = landed(star_pairs(pairs, nodes.select("node", "n_shingles", "registers"), by_estimate, ["n_shingles", "registers"]), "close")
    sets = sets_of(close.select("node").union(close.select("pivot")).distinct())
    links = landed(star_pairs(close, sets.select("node", "members"), by_sets, ["members"]).select(F.col("pivot").alias("u"), F.col("node").alias("v")), "links")
    labels = landed(components(links), "labels")
    # only texts with a likely partner outside their component send their sets through the bands
    registers_ = nodes.select("node", "n_shingles", "registers")
    open_ = landed(_open_cells(landed(_crowds(members), "crowds"), labels, registers_, ["n_shingles", "registers"], _cell_partners(percent), "key long, node long", NARROW).distinct(), "open")
    more = landed(_open_cells(open_, labels, sets_of(open_.select("node").distinct()), ["n_shingles", "registers", "members"], _cell_links(percent), "u long, v long"), "links")
    if not more.isEmpty():
        labels = landed(components(links.unionByName(more)), "labels")

    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = named.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    by_set = join_groups(named.select("label", "set", "size"), firsts, "label", "n", total).select("set", "size", "component_id")
    judged = join_groups(some.select("doc_id", "n_shingles", "set"), by_set, "set", "size", total)
    alone = rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return judged.select(columns).unionByName(alone.select(columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _crowds(members: DataFrame) -> DataFrame:
    """``key`` and ``node`` of the bands of more than two texts; those of one first text are one band if that halves their rows."""
    met = members.filter("n > 2").groupBy(F.col("pivot.node").alias("pivot"), "node").agg(F.collect_list("key").alias("keys"))
    first = met.groupBy("pivot").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("keys")).alias("rows"))
    bands = F.when(F.col("rows") >= 2 * F.col("texts"), F.array("pivot")).otherwise(F.col("keys"))
    return join_groups(met, first, "pivot", "texts", members.count()).select(F.explode(bands).alias("key"), "node")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))


def _open_cells(members: DataFrame, labels: DataFrame, payload: DataFrame, columns: list[str], task: Callable, schema: str, times: int = 1) -> DataFrame:
    """``task`` over the cells of bands of several components, each text outside a band's largest component against all of the band."""
    known = landed(_labelled(members, labels), "open")
    sizes = known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("all"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("rows"), F.sum("all").alias("all")).filter("top.n < rows")
    once = mixed.groupBy("all", "rows").agg(F.min(F.struct("key", "top")).alias("one")).select(  # bands of the same texts count once
        F.col("one.key").alias("key"), F.col("one.top.label").alias("top"), "rows",
        F.ceil((F.col("rows") - F.col("one.top.n")) / F.lit(times * BLOCK)).cast("int").alias("blocks"), F.ceil(F.col("rows") / F.lit(times * BAND_BLOCK)).cast("int").alias("bands"))
    rows = join_groups(known, once, "key", "rows", members.count())
    here = lambda count: F.pmod(F.xxhash64("node"), count).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    one = (F.col("blocks") == 1) & (F.col("bands") == 1)
    outside = F.col("label") != F.col("top")
    some = rows.filter(outside & ~one).select("key", here(F.col("blocks")).alias("block"), every("bands").alias("band"), F.lit(0).alias("side"), "node", "label")
    whole = rows.select("key", every("blocks").alias("block"), here(F.col("bands")).alias("band"), F.when(one & outside, 2).otherwise(1).alias("side"), "node", "label")
    full = some.unionByName(whole).join(payload, "node")
    return (full.select("key", "block", "band", "side", "node", "label", *columns)
            .repartition("key", "block", "band").sortWithinPartitions("key", "block", "band").mapInArrow(tidy(task), schema))


def drop_near_copies(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``df`` that stay, whole: of each component the row with the least id, null last, and digest of its text.

    Rows that repeat both id and text stay or go together; ``drop_copies`` leaves one of them.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    own = F.struct(F.col(id).isNull().alias("unnamed"), F.col(id).alias("id"), digest.alias("digest"))
    rows = df.select(own.alias("own"), F.col(text).alias("text"))
    return without(df, own, near_copies(rows, "own", "text", percent).filter("not kept").select("doc_id"))
