import io
import random

import pyarrow as pa
import pytest

from sievework.llm.warc import MAGIC, parsed, read_warc, record, records, sha1_base32, warc_round_trip, write_warc

PAGES = [
    (1, "http://a/x", "<p>one</p>"), (2, "http://b/y z\n", "<p>one</p>"), (3, None, None), (4, "http://c", ""), (5, "http://é", "é" * 2000),
    (6, "http://d", "<p>one</p>"), (6, "http://d", "<p>one</p>"), (7, "u", "x" * 3_000_000), (None, "v", "<p>one</p>"), (None, "w", "alone\r\n\r\nhead")]
SCHEMA = "page_id long, url string, html string, digest string, refers_to string, revisit string, first_id string, n string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, *["clash"] * 5) for p in PAGES], SCHEMA).repartition(2)


def expected():
    least = {}
    for i, _, h in PAGES:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    out = []
    for i, _, h in PAGES:
        data, first = (h or "").encode(), least.get(h or "")
        revisit = i != first
        out.append((i, len(data), sha1_base32(data), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(pages, spark):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, warc_round_trip(pages).select(columns).collect()), key=repr) == expected()
    assert warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("split", [50, 333, 1 << 20])
def test_any_split_gives_every_record_once(pages, tmp_path, split):
    files = write_warc(pages.filter("page_id is null or page_id <> 7"), f"file://{tmp_path}")
    rows = read_warc(files, split_bytes=split).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in rows if r["page_id"]) == sorted((i, len((h or "").encode())) for i, _, h in PAGES if i and i != 7)
    payload = {r["page_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    assert payload[5] == ("é" * 2000).encode() and payload[3] == b"" and payload[1] == b"<p>one</p>"


def test_magic_inside_a_payload_is_no_record():
    rng = random.Random(1)
    payloads = [bytes(rng.randrange(256) for _ in range(500)) + MAGIC * 3 + b"WARC/1.1" for _ in range(20)]
    data = b"".join(record(k, None, p, sha1_base32(p), None, False, "d") for k, p in enumerate(payloads))
    file = pa.PythonFile(io.BytesIO(data), mode="r")
    found = [parsed(r) for a in range(0, len(data), 97) for r in records(file, len(data), a, a + 97)]
    assert [r["page_id"] for r in found] == list(range(20)) and [r["payload"] for r in found] == payloads


def test_a_response_that_is_not_whole_is_an_error():
    with pytest.raises(ValueError):
        parsed(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 24\r\n\r\n"
               b"HTTP/1.1\r\nContent-Length: 9\r\n\r\nab")
