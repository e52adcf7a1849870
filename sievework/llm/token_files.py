"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents as one stream in blocks of 1,024. A block subtracts its
minimum and packs the low bits of every id at the width that most of them need: of the widths of some
percentiles the one that gives the fewest bytes. Ids that need more are exceptions, kept as a list of
positions and high parts. The last block may be short; its packed part is filled with zeros.

    bytes                      content
    8                          "PFORTOK1"
    blocks                     minimum u32, ids u16, width u8, 0 u8, exceptions u16, 0 u16; 16 * width u64; exceptions: positions u16, high parts u32
    footer                     starts of the blocks u64, ids of the documents i64, their ends among the file's token ids u64, their nulls u8
    24                         number of blocks u64, number of documents u64, start of the footer u64

All numbers are little-endian. Documents are dealt to files by ranges of their id and sorted, so files and
documents ascend; a document's first place among all tokens is its place in the file plus the
lengths of earlier files.

Defined results: a null text is empty and has its end id only; a null document id comes first; rows that repeat
an id stand together; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import documents_of, landed, shared, sliced
from .files import create, opened
from .tokens import worker_encoder

MAGIC = b"PFORTOK1"
BLOCK = 1024
LANE = 64
PERCENTILES = (0.9, 0.95, 0.98, 0.99, 1.0)
HEAD = np.dtype([("minimum", "<u4"), ("n", "<u2"), ("width", "u1"), ("_", "u1"), ("exceptions", "<u2"), ("__", "<u2")])
#: Blocks decoded at once.
STRIDE = 1024
#: Chunks of text that a worker's tasks keep with their ids.
KEPT = 1_000_000


def pack_bits(low: np.ndarray, width: int) -> np.ndarray:
    """Rows of 1,024 numbers below 2**width as rows of 16 * width 64-bit words; 64 numbers share ``width`` words."""
    lanes = low.reshape(-1, LANE).astype(np.uint64)
    out = np.zeros((len(lanes), width), np.uint64)
    for j in range(LANE):
        word, shift = divmod(j * width, 64)
        out[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return out.reshape(len(low), -1)


def unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(-1, width)
    out = np.zeros((len(lanes), LANE), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(LANE):
        word, shift = divmod(j * width, 64)
        value = lanes[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | lanes[:, word + 1] << np.uint64(64 - shift)
        out[:, j] = value & mask
    return out.reshape(-1, BLOCK)


def widths(above: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The width of each block that takes the fewest bytes among those of the percentiles."""
    fits = np.stack([(above < (1 << w)).sum(axis=1) if w < 32 else np.full(len(above), BLOCK) for w in range(33)], axis=1)
    best, size = np.zeros(len(above), np.int64), np.full(len(above), np.iinfo(np.int64).max)
    for p in PERCENTILES:
        wanted = np.ceil(p * n).astype(np.int64) + (BLOCK - n)  # the filling zeros fit any width
        width = (fits >= wanted[:, None]).argmax(axis=1)
        cost = width * (BLOCK // 8) + 6 * (BLOCK - np.take_along_axis(fits, width[:, None], 1)[:, 0])
        best, size = np.where(cost < size, width, best), np.minimum(cost, size)
    return best


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids; all but the last are full."""
    blocks = -(-len(ids) // BLOCK)
    n = np.full(blocks, BLOCK)
    if len(ids) % BLOCK:
        n[-1] = len(ids) % BLOCK
    filled = np.full(blocks * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    filled[:len(ids)] = ids
    rows = filled.reshape(blocks, BLOCK)
    minimum = rows.min(axis=1)
    above = rows - minimum[:, None]
    if blocks:
        above[-1, n[-1]:] = 0
    width = widths(above, n)
    out: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        part = above[of]
        words = pack_bits(part & np.uint32((1 << int(w)) - 1), int(w)) if w else np.zeros((len(of), 0), np.uint64)
        at, position = np.nonzero(part >> np.uint32(w)) if w < 32 else (np.zeros(0, int), np.zeros(0, int))
        high = (part[at, position] >> np.uint32(w)).astype("<u4")
        ends = np.searchsorted(at, np.arange(len(of) + 1))
        for k, b in enumerate(of):
            a, z = ends[k], ends[k + 1]
            head = np.array([(minimum[b], n[b], w, 0, z - a, 0)], HEAD)
            out[b] = head.tobytes() + words[k].astype("<u8").tobytes() + position[a:z].astype("<u2").tobytes() + high[a:z].tobytes()
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at the given places of ``data``."""
    raw = np.frombuffer(data, np.uint8)
    heads = raw[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD)[:, 0]
    rows = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(heads["width"]):
        of = np.flatnonzero(heads["width"] == w)
        size = int(w) * BLOCK // 8
        if w:
            rows[of] = unpack_bits(raw[(starts[of] + HEAD.itemsize)[:, None] + np.arange(size)].copy().view("<u8"), int(w))
    for b in np.flatnonzero(heads["exceptions"]):
        count, w = int(heads["exceptions"][b]), int(heads["width"][b])
        at = int(starts[b]) + HEAD.itemsize + w * BLOCK // 8
        position = np.frombuffer(data, "<u2", count, at)
        rows[b, position] |= np.frombuffer(data, "<u4", count, at + 2 * count) << np.uint32(w)
    rows += heads["minimum"][:, None]
    return rows.reshape(-1)[:(len(starts) - 1) * BLOCK + int(heads["n"][-1])] if len(starts) else np.zeros(0, np.uint32)


class Writer:
    """Writes one file; holds less than a stride of ids."""

    def __init__(self, stream):
        self.stream, self.at = stream, len(MAGIC)
        self.starts, self.ids, self.ends, self.held = [], [], [], []
        self.tokens = self.waiting = 0
        stream.write(MAGIC)

    def add(self, id: int | None, ids: bytes) -> None:
        self.ids.append(id)
        self.tokens += len(ids) // 4
        self.ends.append(self.tokens)
        self.held.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= STRIDE * BLOCK:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        for block in encode_blocks(ids[:n]):
            self.starts.append(self.at)
            self.at += len(block)
            self.stream.write(block)
        self.held, self.waiting = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> None:
        self._flush(self.waiting)
        for kind, values in (("<u8", self.starts), ("<i8", [i or 0 for i in self.ids]), ("<u8", self.ends), ("u1", [i is None for i in self.ids])):
            self.stream.write(np.array(values, kind).tobytes())
        self.stream.write(np.array([len(self.starts), len(self.ids), self.at], "<u8").tobytes())
        self.stream.close()


class Reader:
    """Reads the documents of one file in order, or the ids of any range."""

    def __init__(self, file):
        self.file = file
        tail = np.frombuffer(file.read_at(24, file.size() - 24), "<u8").astype(np.int64)
        blocks, docs, self.footer = map(int, tail)
        data = file.read_at(file.size() - 24 - self.footer, self.footer)
        self.starts = np.append(np.frombuffer(data, "<u8", blocks).astype(np.int64), self.footer)
        self.ids = np.frombuffer(data, "<i8", docs, 8 * blocks)
        self.ends = np.frombuffer(data, "<u8", docs, 8 * (blocks + docs)).astype(np.int64)
        self.null = np.frombuffer(data, "u1", docs, 8 * (blocks + 2 * docs))

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to before ``last``."""
        a = int(self.starts[first])
        return decode_blocks(self.file.read_at(int(self.starts[last]) - a, a), self.starts[first:last] - a)

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """Id, first place in the file and parts of the ids of each document; a stride of blocks is held."""
        have, base, next_block, at = np.zeros(0, np.uint32), 0, 0, 0
        for id, end, null in zip(self.ids, self.ends, self.null):
            start, parts = at, []
            while at < end:
                if at - base >= len(have):
                    base = next_block * BLOCK
                    last = min(next_block + STRIDE, len(self.starts) - 1)
                    have, next_block = self.blocks(next_block, last), last
                part = have[at - base:end - base]
                parts.append(part)
                at += len(part)
            yield None if null else int(id), start, parts


def write_tokens(df: DataFrame, tokenizer: str, end: int, folder: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files; returns their table: ``part``, ``path``, ``documents``, ``tokens``, ``bytes``, ``base`` (tokens before it)."""
    docs = documents_of(df.withColumn(id, df[id].cast("long")), id, text).repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail, writer = worker_encoder(tokenizer, True, KEPT, folder), end.to_bytes(4, "little"), None
        part = TaskContext.get().partitionId()
        for batch in sliced(batches):
            if writer is None:
                stream, path = create(folder, f"tokens-{part:06d}", ".pfor")
                writer = Writer(stream)
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                writer.add(key, ids + tail)
        if writer is not None:
            writer.close()
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([path]), pa.array([len(writer.ids)], pa.int64()),
                                   pa.array([writer.tokens], pa.int64()), pa.array([writer.at], pa.int64())],
                                  names=["part", "path", "documents", "tokens", "bytes"])

    written = landed(docs.mapInArrow(task, "part int, path string, documents long, tokens long, bytes long"), "token-files")
    return written.withColumn("base", F.coalesce(F.expr("sum(tokens) over (order by part rows between unbounded preceding and 1 preceding)"), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document in the files of the table."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as file:
                    rows = []
                    for key, start, parts in Reader(file).documents():
                        crc = 0
                        for part in parts:
                            crc = crc32(part.astype("<u4").tobytes(), crc)
                        rows.append((key, base + start, sum(map(len, parts)), crc))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = files.select("path", "base").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(df: DataFrame, tokenizer: str, end: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents under the shared folder and read them back."""
    return read_tokens(write_tokens(df, tokenizer, end, shared(df.sparkSession, "tokens"), id, text))
