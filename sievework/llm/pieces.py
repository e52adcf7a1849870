"""SentencePiece encoding that keeps byte offsets, and decoding.

A text is normalised by the longest prefixes in the model's compiled character map, a double-array
trie; for every normalised byte the place it came from is kept. The library gives the ids; each piece's bytes
among the normalised ones follow from the pieces' lengths, and so its span in the original text.
A model without a map leaves characters as they are, and whole slices are aligned by array operations.

Defined results: a null text is empty and has no pieces; its decoded text is empty. Rows that repeat an id are
encoded each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents_of, sliced

SPACE = "▁".encode()


class CharacterMap:
    """The compiled map: a size, the units of a double-array trie, and the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replacements = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at a place."""
        if not self.units:
            return None
        found, unit = None, self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for end in range(at, len(data)):
            byte = data[end]
            node ^= byte
            unit = self.units[node]
            if (unit & 0x800000FF) != byte:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = (end + 1 - at, value)
        if found is None:
            return None
        stop = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1]:stop]


class Normalizer:
    """Normalised bytes of a text and, for each and one more, the place of the original byte."""

    def __init__(self, charmap: bytes, dummy_prefix: bool, trim: bool, escape: bool):
        self.map, self.dummy_prefix, self.trim = CharacterMap(charmap), dummy_prefix, trim
        self.space = SPACE if escape else b" "

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        return self.plain(data) if not self.map.units and not self.trim else self.mapped(data)

    def plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, np.int64)
        lengths = np.where(np.frombuffer(data, np.uint8) == 32, len(self.space), 1)
        lead = len(self.space) if self.dummy_prefix else 0
        origin = np.concatenate([np.zeros(lead, np.int64), np.repeat(np.arange(len(data)), lengths), [len(data)]])
        return (self.space if lead else b"") + data.replace(b" ", self.space), origin

    def mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        steps, at = [], 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                first = data[at]
                n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                hit = (n, data[at:at + n])
            steps.append((at, at + hit[0], hit[1]))
            at += hit[0]
        end = len(data)
        if self.trim:
            while steps and steps[0][2].strip(b" ") == b"":
                steps.pop(0)
        if not steps:
            return b"", np.array([end], np.int64)
        out, origin = bytearray(), []
        def add(part: bytes, place: int) -> None:
            out.extend(part)
            origin.extend([place] * len(part))
        if self.dummy_prefix:
            add(self.space, steps[0][0])
        after_space = self.trim
        for place, _, part in steps:
            if self.trim and after_space:
                part = part.lstrip(b" ")
            if part:
                for byte in part:
                    add(self.space if byte == 32 else bytes([byte]), place)
                after_space = self.trim and part.endswith(b" ")
        last = steps[-1][1]
        if self.trim:
            while out.endswith(self.space):
                last = origin[len(out) - len(self.space)]
                del out[-len(self.space):], origin[-len(self.space):]
        return bytes(out), np.array([*origin, last], np.int64)


class PieceEncoder:
    """Ids of the library, byte spans of the pieces, and the decoded text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        self.normalize = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        byte, unknown = 6, 2  # kinds of pieces in the model file
        self.lengths = np.array([1 if p.type == byte else -1 if p.type == unknown else len(p.piece.encode()) for p in proto.pieces])
        self.decimal = [str(k) for k in range(len(proto.pieces))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def spans(self, text: str, ids: list[int]) -> np.ndarray:
        """First byte and the byte behind the last of each piece in the text as UTF-8."""
        normal, origin = self.normalize(text.encode())
        lengths = self.lengths[np.array(ids, np.int64)] if ids else np.zeros(0, np.int64)
        open_ = np.flatnonzero(lengths < 0)
        if len(open_):  # an unknown piece ends where the next known one is found
            pieces = [self.model.id_to_piece(i).encode() for i in ids]
            lengths, at = lengths.copy(), 0
            for k in range(len(ids)):
                if lengths[k] < 0:
                    known = next((j for j in range(k + 1, len(ids)) if lengths[j] >= 0), None)
                    lengths[k] = (normal.index(pieces[known], at + 1) if known is not None else len(normal)) - at
                at += lengths[k]
        ends = np.cumsum(lengths)
        if len(ids) and ends[-1] != len(normal):
            raise ValueError("the pieces do not make up the normalised text")
        return np.stack([origin[ends - lengths], origin[ends]], axis=1)


def encode_pieces(df: DataFrame, model: str, id: str = "doc_id", text: str = "text", outputs: bool = True) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``spans_crc32`` of each row.

    With ``outputs`` also ``ids``, ``begins`` and ``ends`` (bytes of the text as UTF-8) and ``decoded``.
    ``spans_crc32`` is over begins and ends by turns as little-endian unsigned 32-bit numbers.
    """
    docs = documents_of(df, id, text)
    extra = ", ids array<int>, begins array<int>, ends array<int>, decoded string" if outputs else ""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model)
        decimal = encoder.decimal
        for batch in sliced(batches, size=1 << 20):
            texts = batch.column(1).to_pylist()
            ids = encoder.encode(texts)
            spans = [encoder.spans(t, i) for t, i in zip(texts, ids)]
            decoded = [encoder.model.decode(i) if i else "" for i in ids]
            columns = [
                batch.column(0), pa.array([len(i) for i in ids], pa.int64()),
                pa.array([hashlib.sha256(",".join([decimal[k] for k in i]).encode()).hexdigest() for i in ids]),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]), pa.array([crc32(s.astype("<u4").tobytes()) for s in spans], pa.int64())]
            if outputs:
                columns += [pa.array(ids, pa.list_(pa.int32())), *[pa.array([s[:, k].astype(np.int32) for s in spans], pa.list_(pa.int32())) for k in (0, 1)], pa.array(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "ids", "begins", "ends", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names[:len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(task, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long" + extra)
