"""WARC archives of pages, and a reader that splits them.

Every record is a gzip member of its own. The reader deals byte ranges to tasks, not files: a task looks
for the gzip magic in its range, takes a place for a member only if it decompresses to a WARC header,
and owns the records that start in its range, reading past its end for the last. Behind a valid
member the next one is expected at once; where none follows, the search goes on.

Of pages with equal payloads of at least ``least_bytes`` the one with the smallest id is a response, the
others are revisits that refer to it and carry no payload.

Defined results: a null html is an empty payload; pages with the same id and payload are all responses when
theirs is the smallest id; a null id is larger than any other; a null or odd url is written as far as a header
can hold it; an empty table gives no archives and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import join_groups, landed, shared, sliced
from .files import create, opened

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a byte range, of one read, and of an archive before the next one is begun.
SPLIT, STEP, ROLL = 16 << 20, 1 << 20, 256 << 20


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def _page(urn: str | None) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "None"
    return None if number == "None" else int(number)


def parsed(data: bytes) -> dict:
    """Type, ids, digest and payload of a record; the digest of a response is that of the bytes read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    response = fields["WARC-Type"] == "response"
    if response and size != len(payload):
        raise ValueError("a response is not whole")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and sha1_base32(payload) != digest:
        raise ValueError("a payload is not what its digest says")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": _page(fields.get("WARC-Refers-To")), "payload": payload if response else None}


def member(file, at: int, size: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at a place and the place behind it; None if no WARC record starts there."""
    unpack, parts, tested = zlib.decompressobj(31), [], False
    while at < size:
        chunk = file.read_at(min(STEP, size - at), at)
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error:
            return None
        if not tested and sum(map(len, parts)) >= len(VERSION):
            if not b"".join(parts).startswith(VERSION):
                return None
            tested = True
        at += len(chunk)
        if unpack.eof:
            return (b"".join(parts), at - len(unpack.unused_data)) if tested else None
    return None


def records(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """The records that start in a byte range."""
    at = start
    while at < min(end, size):
        window = file.read_at(min(STEP + len(MAGIC) - 1, size - at), at)
        found = window.find(MAGIC)
        if found < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        content = member(file, at, size)
        if content is None:
            at += 1
        else:
            yield content[0]
            at = content[1]


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to`` and ``revisit`` to pages of ``page_id``, ``url``, ``html``."""
    digest = F.sha1(F.col("html").cast("binary"))
    narrow = landed(pages.filter(F.octet_length("html") >= least_bytes).select("page_id", digest.alias("digest")), "digests")
    groups = narrow.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = join_groups(narrow, groups, "digest", "n", narrow.count()).filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
    again = again.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "first_id").distinct()
    return pages.join(again, pages["page_id"].eqNullSafe(again["_id"]) & (digest == again["_digest"]), "left").select(
        "page_id", "url", "html", F.col("first_id").alias("refers_to"), F.col("_digest").isNotNull().alias("revisit"))


def write_warc(
    df: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write the archives; returns their table: ``path``, ``bytes``, ``records``."""
    pages = df.select(df[id].cast("long").alias("page_id"), df[url].alias("url"), F.coalesce(df[html], F.lit("")).alias("html"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, part = None, TaskContext.get().partitionId()
        done = []
        for batch in sliced(batches, "html"):
            for page_id, address, text, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None or size >= ROLL:
                    if stream is not None:
                        stream.close()
                        done.append((path, size, count))
                    (stream, path), size, count = create(folder, f"pages-{part:06d}", ".warc.gz"), 0, 0
                payload = text.encode()
                data = record(page_id, address, payload, sha1_base32(payload), refers_to, revisit, date)
                stream.write(data)
                size, count = size + len(data), count + 1
        if stream is not None:
            stream.close()
            done.append((path, size, count))
            paths, sizes, counts = zip(*done)
            yield pa.record_batch([pa.array(paths), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["path", "bytes", "records"])

    return landed(with_revisits(pages, least_bytes).mapInArrow(task, "path string, bytes long, records long"), "archives")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(files: DataFrame, split_bytes: int = SPLIT, payloads: bool = True) -> DataFrame:
    """The records of archives given by ``path`` and ``bytes``."""
    splits = files.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    number = splits.count()
    names = [c.split()[0] for c in RECORD.split(", ") if payloads or not c.startswith("payload ")]
    schema = ", ".join(c for c in RECORD.split(", ") if c.split()[0] in names)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c.split()[0]] for r in rows], kinds[c.split()[1]]) for c in schema.split(", ")], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(path) as file:
                    rows, held = [], 0
                    for data in records(file, size, start, start + split_bytes):
                        rows.append(parsed(data))
                        held += len(data) if payloads else 200
                        if held > STEP:
                            yield packed(rows)
                            rows, held = [], 0
                    if rows:
                        yield packed(rows)

    return splits.repartition(max(1, number), "path", "start").mapInArrow(task, schema)


def warc_round_trip(df: DataFrame, **options) -> DataFrame:
    """Write the pages under the shared folder and read the records back, without their payloads."""
    return read_warc(write_warc(df, shared(df.sparkSession, "warc"), **options), payloads=False)
