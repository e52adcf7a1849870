"""Conversations as a prefix trie: double arrays per shard, upper nodes merged over all shards.

A conversation is a sequence of turns; a node is a distinct sequence of first turns. Turns are cut into
segments of ``SEGMENT`` places; a segment hangs from the node where it starts, named by its depth and by
two 64-bit XOR sums of the hashes of all turns before with their places. So a path of any length is spread over
many tasks. Equal segments count once, with the number of conversations that pass, however many these are.

Segments are dealt into shards by the node they start from and their first turn; a prefix of many different segments is
dealt on by their hashes. In a shard the turns get dense ids in order of frequency, and the segments' tries
are packed into one double array: the child of node ``s`` by id ``c`` is ``t = BASE[s] + c`` where
``CHECK[t] = s``. A traversal sums what the segments carry over each node's subtree. Nodes that
several shards hold (those above a dealt prefix) are merged by one aggregate.

Sums over whole subtrees need no walk from the leaves: a node belongs to its least member, and every
conversation carries one for the leaf that it owns and the tokens saved at all nodes that it owns. A second traversal sums
these over the members of each node; what the owner saves above the node is taken off again.

Defined results: null roles and texts are empty; rows without a conversation id belong to no conversation
and are left out; turns are ordered by turn (null first), equal turns by the hashes of role and text, and a repeated row is
a turn of its own; an empty table gives no node; other columns are not read. Texts are read only to be hashed and
measured, so long ones need no memory. Sequences are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import join_groups, landed

#: Turns of a segment.
SEGMENT = 64
#: Different segments of one prefix that stay together, and that a shard holds on average.
TOGETHER = 512
#: Conversation ids of one piece of a node's list of ends.
PIECE = 4_096
#: The most turns that a conversation takes from another one's start.
HEAD = 5
NONE = hashlib.sha256(b"").hexdigest()


# ---- the double array ----------------------------------------------------------

class DoubleArray:
    """Tries over dense ids in two arrays; node 0 is the root, -1 in CHECK marks a free place."""

    def __init__(self, size: int = 1024):
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[0] = 0
        self.free = 1  # no free place lies before it

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def place(self, node: int, ids: np.ndarray) -> np.ndarray:
        """Children of a node for ascending ids, at the first base where all their places are free."""
        while self.free < len(self.check) and self.check[self.free] >= 0:
            self.free += 1
        first = self.free
        while True:
            self._room(first + int(ids[-1] - ids[0]) + 1)
            at = first - int(ids[0]) + ids
            taken = self.check[at] >= 0
            if not taken.any():
                break
            first += 1
            while first < len(self.check) and self.check[first] >= 0:
                first += 1
        self.base[node] = first - ids[0]
        self.check[at] = node
        return at

    def child(self, node: int, id: int) -> int:
        """The child of a node by an id, -1 if there is none."""
        t = int(self.base[node]) + id
        return t if 0 < t < len(self.check) and self.check[t] == node else -1


def packed(sequences: list[np.ndarray]) -> tuple[DoubleArray, np.ndarray]:
    """The double array of sequences of dense ids, and the node where each one ends.

    The sequences are sorted; a node is a run of them, and its children are placed together, level by level.
    """
    width = max(map(len, sequences), default=0)
    table = np.full((len(sequences), width + 1), -1, np.int64)
    for k, s in enumerate(sequences):
        table[k, :len(s)] = s
    order = np.lexsort(table.T[::-1])
    table = table[order]
    trie, ends = DoubleArray(2 * sum(map(len, sequences)) + 2), np.zeros(len(sequences), np.int64)
    level = [(0, 0, len(sequences))]
    for depth in range(width + 1):
        below = []
        for node, a, b in level:
            column = table[a:b, depth]
            start = a + int(np.searchsorted(column, 0))  # those that end here come first
            ends[order[a:start]] = node
            if start < b:
                edges = np.concatenate([[start], start + 1 + np.flatnonzero(np.diff(table[start:b, depth])), [b]])
                nodes = trie.place(node, table[edges[:-1], depth])
                below += zip(nodes.tolist(), edges[:-1].tolist(), edges[1:].tolist())
        level = below
    return trie, ends


def _traversed(trie: DoubleArray, ends: np.ndarray, carried: list[np.ndarray], least: np.ndarray) -> tuple:
    """Nodes by levels from CHECK, with the sums of ``carried`` and the least of ``least`` over each one's sequences."""
    nodes = np.flatnonzero(trie.check >= 0)
    nodes = nodes[nodes > 0]
    parent = trie.check[nodes]
    order = np.argsort(parent, kind="stable")
    nodes, parent = nodes[order], parent[order]
    sums = [np.zeros(len(trie.check), np.int64) for _ in carried]
    low = np.full(len(trie.check), np.iinfo(np.int64).max)
    for s, x in zip(sums, carried):
        np.add.at(s, ends, x)
    np.minimum.at(low, ends, least)
    levels, above = [], np.array([0])
    while len(above):
        a, b = np.searchsorted(parent, above, "left"), np.searchsorted(parent, above, "right")
        above = nodes[np.repeat(a, b - a) + np.arange(int((b - a).sum())) - np.repeat(np.cumsum(b - a) - (b - a), b - a)]
        levels.append(above)
    for at in reversed(levels[:-1]):
        for s in sums:
            np.add.at(s, trie.check[at], s[at])
        np.minimum.at(low, trie.check[at], low[at])
    return levels[:-1], sums, low


NODE = "depth long, a long, b long, pa long, pb long, chars long, first long, second long, conv_id long"


def _shard_nodes() -> Callable:
    """Nodes of the double array of each shard of sorted rows: depth, name, parent's name, length of the last turn, sums and least id."""
    def nodes_of(rows: list[tuple]) -> pa.RecordBatch:
        # a row: depth and name of the start, turns (hash pairs with their places, raw pairs, lengths), two sums, least id
        starts, codes, texts = {}, {}, []
        tokens = [[("start", *r[:3]), *[(x["a"], x["b"]) for x in r[3]]] for r in rows]
        seen: dict = {}
        for t in tokens:
            for x in t:
                seen[x] = seen.get(x, 0) + 1
        dense = {x: k for k, x in enumerate(sorted(seen, key=lambda x: (-seen[x], str(x))))}
        sequences = [np.array([dense[x] for x in t], np.int64) for t in tokens]
        trie, ends = packed(sequences)
        levels, sums, low = _traversed(trie, ends, [np.array([r[4] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)],
                                       np.array([r[6] for r in rows], np.int64))
        name = np.zeros((len(trie.check), 3), np.int64)  # depth and the two sums
        chars = np.zeros(len(trie.check), np.int64)
        for r, s in zip(rows, sequences):  # each turn's place, length and hash along its path
            node = trie.child(0, int(s[0]))
            name[node] = r[:3]
            for x, c in zip(r[3], s[1:].tolist()):
                above, node = node, trie.child(node, c)
                if name[node, 0] == 0:
                    name[node] = name[above, 0] + 1, name[above, 1] ^ x["ha"], name[above, 2] ^ x["hb"]
                    chars[node] = x["chars"]
        at = np.concatenate(levels[1:]) if len(levels) > 1 else np.zeros(0, np.int64)
        up = name[trie.check[at]]
        columns = [*name[at].T, up[:, 1], up[:, 2], chars[at], sums[0][at], sums[1][at], low[at]]
        return pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=[c.split()[0] for c in NODE.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    if rows:
                        yield nodes_of(rows)
                    current, rows = shard, []
                rows.append(row)
        if rows:
            yield nodes_of(rows)

    return task


# ---- conversations as segments -----------------------------------------------------

def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``a``, ``b``, ``chars`` of every turn.

    Rows are dealt by sampled ranges of id and turn, so a long conversation lies in several of them.
    """
    order = ["conv_id", "turn", "a", "b"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    written = landed(dealt.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "turns")
    ranges = written.groupBy("range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranges.select("range", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    placed = written.join(F.broadcast(shift), "range").withColumn("global", F.col("at") + F.col("shift")).drop("range", "at", "shift", "turn")
    firsts = placed.groupBy("conv_id").agg(F.min("global").alias("start"), F.count(F.lit(1)).alias("turns"))
    met = join_groups(placed, firsts, "conv_id", "turns", written.count())
    return landed(met.select("conv_id", (F.col("global") - F.col("start")).alias("place"), "turns", "a", "b", "chars"), "placed")


def turns_of(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Hashes and lengths of the turns of conversations with an id."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(F.lit(1), r, t).alias("a"), F.xxhash64(F.lit(2), r, t).alias("b"),
                     F.length(t).cast("long").alias("chars")).filter("conv_id is not null")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the first turns of another one: ``conv_id``, ``turns``; and all their turns with new places.

    The first h turns of conversation c - c % 100 (h: CRC-32 of the decimal c, modulo 6), then c's own ones after its first h.
    """
    convs = placed.groupBy("conv_id").agg(F.max("turns").alias("own")).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")).withColumn("root", F.col("conv_id") - F.col("conv_id") % 100)
    heads = placed.filter(f"conv_id % 100 = 0 and place < {HEAD}").groupBy(F.col("conv_id").alias("root")).agg(
        F.sort_array(F.collect_list(F.struct("place", "a", "b", "chars"))).alias("head"))
    known = landed(convs.join(heads, "root", "left").select(
        "conv_id", "own", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")).alias("head")), "heads")
    taken = F.size("head")
    ends = known.select("conv_id", (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))
    moved = join_groups(placed.select("conv_id", "place", "a", "b", "chars"), known.select("conv_id", "own", "h", taken.alias("taken")), "conv_id", "own", placed.count())
    own = moved.filter("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "a", "b", "chars")
    return ends, known.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.*").unionByName(own)


def segments(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``a``, ``b`` (the node where it starts) and ``path`` (its turns) of every segment of the conversations' turns."""
    hashed = turns.select("conv_id", F.floor(F.col("place") / SEGMENT).alias("s"), F.struct(
        "place", "a", "b", "chars", F.xxhash64(F.lit(3), "place", "a", "b").alias("ha"), F.xxhash64(F.lit(4), "place", "b", "a").alias("hb")).alias("x"))
    cut = hashed.groupBy("conv_id", "s").agg(F.sort_array(F.collect_list("x")).alias("path"))
    fold = lambda h: F.aggregate("path", F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(x[h]))
    done = landed(cut.select("conv_id", "s", "path", fold("ha").alias("xa"), fold("hb").alias("xb")), "segments")
    # only conversations of several segments look back; a row is as short as two numbers for each 64 turns
    before = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    long = done.filter("s > 0").select("conv_id").distinct()
    later = done.join(long, "conv_id", "left_semi").select("conv_id", "s", F.bit_xor("xa").over(before).alias("a"), F.bit_xor("xb").over(before).alias("b")).filter("s > 0")
    zero = F.lit(0).cast("long")
    started = done.filter("s = 0").select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), "path", "xa", "xb").unionByName(
        done.filter("s > 0").join(later, ["conv_id", "s"]).select("conv_id", (F.col("s") * SEGMENT).alias("depth"), "a", "b", "path", "xa", "xb"))
    return landed(started, "segments")


def shard_nodes(cut: DataFrame, first: Column, second: Column) -> DataFrame:
    """Nodes below the root with the sums of two columns over their members and the least member, merged over all shards."""
    same = cut.groupBy("depth", "a", "b", "xa", "xb").agg(
        F.first("path").alias("path"), F.sum(first).alias("first"), F.sum(second).alias("second"), F.min("conv_id").alias("conv_id"))
    same = landed(same.withColumn("prefix", F.xxhash64("depth", "a", "b", F.get("path", F.lit(0))["a"])), "paths")
    total = same.count()
    sizes = same.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    met = join_groups(same, sizes, "prefix", "n", total)
    salt = F.when(F.col("n") > TOGETHER, F.pmod(F.xxhash64("xa"), F.ceil(F.col("n") / TOGETHER))).otherwise(0)
    shards = max(1, -(-total // TOGETHER))
    dealt = met.select(F.pmod(F.xxhash64("prefix", salt), F.lit(shards)).alias("shard"), "depth", "a", "b", "path", "first", "second", "conv_id")
    nodes = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(_shard_nodes(), NODE)
    return nodes.groupBy("depth", "a", "b").agg(
        F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("chars").alias("chars"), F.sum("first").alias("first"), F.sum("second").alias("second"),
        F.min("conv_id").alias("conv_id"))


def _owned_before(nodes: DataFrame) -> DataFrame:
    """Adds ``above``: what the owner of a node saves at nodes above it. Owned paths of any length are summed by blocks of depths."""
    block = nodes.withColumn("block", F.floor(F.col("depth") / PIECE))
    blocks = block.groupBy("conv_id", "block").agg(F.sum("saved").alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select("conv_id", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("earlier"))
    return block.withColumn("inside", F.coalesce(F.sum("saved").over(inside), F.lit(0))).join(sums, ["conv_id", "block"]).withColumn(
        "above", F.col("inside") + F.col("earlier")).drop("block", "inside", "earlier")


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each node's ends, which pass a task in pieces."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        names = ["depth", "a", "b", "ends_sha256"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            out = []
            for d, a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (d, a, b) != current:
                    if current is not None:
                        out.append((*current, digest.hexdigest()))
                    current, digest = (d, a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pa.record_batch([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)
        if current is not None:
            yield pa.record_batch([pa.array([x], kind) for x, kind in zip((*current, digest.hexdigest()), kinds)], names=names)

    pieces = ends.groupBy("depth", "a", "b", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return pieces.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "piece").mapInArrow(
        task, "depth long, a long, b long, ends_sha256 string")


def prefix_nodes(turns: DataFrame, ends: DataFrame) -> DataFrame:
    """The trie of conversations: a row per node.

    ``turns``: ``conv_id``, ``place`` (gapless from 0), ``a``, ``b``, ``chars``; ``ends``: ``conv_id`` and ``turns``, their number, also of those without any.
    Returns ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    ends = landed(ends, "ends")
    cut = segments(turns)
    counted = shard_nodes(cut, F.lit(1), F.lit(0)).select("depth", "a", "b", "pa", "pb", "chars", F.col("first").alias("n"), "conv_id")
    zero = F.lit(0).cast("long")
    root = ends.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0").select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"), zero.alias("chars"), "n", "conv_id")
    name = F.struct("depth", "a", "b").alias("node")
    nodes = landed(counted.unionByName(root).select(
        name, F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))).alias("up"), "depth", "n",
        "conv_id", ((F.col("n") - 1) * F.col("chars")).alias("saved")), "nodes")
    total = nodes.count()
    kids = nodes.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = landed(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "parents")
    # what each conversation owns: its leaf, and what its nodes save
    owned = landed(parents.groupBy("conv_id").agg(F.count_if(F.col("n_children") == 0).alias("leaf"), F.sum("saved").alias("saves")).filter("leaf > 0 or saves > 0"), "owned")
    weights = cut.join(owned, "conv_id")
    summed = shard_nodes(weights, F.col("leaf"), F.col("saves")).select(F.struct("depth", "a", "b").alias("node"), F.col("first").alias("leaves"), F.col("second").alias("members_save"))
    every = owned.agg(F.sum("leaf").alias("leaves"), F.sum("saves").alias("members_save")).select(F.struct(zero.alias("depth"), zero.alias("a"), zero.alias("b")).alias("node"), "*")
    sums = summed.unionByName(every)
    # the node where each conversation ends
    last = cut.select("conv_id", (F.col("depth") + F.size("path")).alias("turns"), F.col("a").bitwiseXOR(F.col("xa")).alias("a"), F.col("b").bitwiseXOR(F.col("xb")).alias("b"))
    ended = last.join(ends, ["conv_id", "turns"]).select(F.col("turns").alias("depth"), "a", "b", "conv_id").unionByName(
        ends.filter("turns = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id"))
    digests = _hashed_ends(ended).select(F.struct("depth", "a", "b").alias("node"), "ends_sha256")
    above = parents.filter("n_children > 0").select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size"))
    below = join_groups(parents.filter("up is not null"), above, "up", "size", total).drop("size", "up")
    top = parents.filter("up is null").drop("up").withColumn("parent_conv_id", F.lit(None).cast("long"))
    full = _owned_before(below.unionByName(top)).join(sums, "node", "left").join(digests, "node", "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("members_save", F.lit(0)) - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, rebuild: bool = False, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The nodes of the prefix trie of conversations, as they are or rebuilt with the starts of others."""
    placed = numbered(turns_of(df, id, turn, role, text))
    if rebuild:
        ends, turns = rebuilt(placed)
    else:
        ends, turns = placed.groupBy("conv_id").agg(F.max("turns").alias("turns")), placed.drop("turns")
    return prefix_nodes(turns, ends)
