"""Shards against one sorted list."""

import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from sievework.llm import sharding
from sievework.llm.sharding import document_shards, sharded, write_shards


def slow(rows, shards, law):
    order = sorted(((sha256((t or "").encode()).hexdigest(), i is not None, i or 0), i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in rows)
    total = sum(x[2] if law == "bytes" else 1 for x in order)
    out, before, slots = [], 0, Counter()
    for _, i, size, crc in order:
        shard = before * shards // total
        out.append((i, size, crc, law, shard, slots[shard], None))
        slots[shard] += 1
        before += size if law == "bytes" else 1
    return Counter(out)


def of(df, *a):
    return Counter(tuple(r) for r in document_shards(df, "doc_id", "text", *a).collect())


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_odd_documents(odd, law):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for shards in (1, 3, 8, 100):
        assert of(odd, shards, law) == slow(rows, shards, law)


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_hot_key_and_overfull_ranges(spark, monkeypatch, law):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    rng = random.Random(2)
    texts = ["short"] * 700 + ["x" * 90_000] * 3 + ["word " * rng.randint(1, 400) for _ in range(900)]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = of(df, 8, law)
    assert got == slow(rows, 8, law)
    sizes, counts = Counter(), Counter(x[4] for x in got)
    for x in got:
        sizes[x[4]] += x[1]
    assert max(sizes.values()) - min(sizes.values()) < 2 * 90_001 if law == "bytes" else max(counts.values()) - min(counts.values()) <= 1


def test_ranges_stay_below_the_bound(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGES", 16)
    rows = spark.range(4000).selectExpr("if(id < 3000, 7, id) as k", "if(id < 3000, 1L, 500L) as size", "id as at").selectExpr("struct(k, at) as key", "at", "size")
    found = sharding.splitters(rows, 4000, 3000 + 500 * 1000)
    counts = sharding._ranged(rows, found).groupBy("range").count().collect()
    assert max(r["count"] for r in counts) <= 2 * 4000 // 16 and found == sorted(set(found))


def test_null_sizes_clashing_columns_and_files(spark, tmp_path):
    rows = [(k, None if k % 3 else 5, "old", "old", "c") for k in range(40)] + [(None, 2, "old", "old", "c")]
    df = spark.createDataFrame(rows, "id long, size long, shard string, slot string, `range` string")
    write_shards(df, str(tmp_path / "out"), ["id"], "size", 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter((r["id"], r["size"], r["range"]) for r in back) == Counter((r[0], r[1], r[4]) for r in rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    total, before, want = sum(r[1] or 1 for r in order), 0, {}
    for r in order:
        want[r[0]] = before * 4 // total
        before += r[1] or 1
    assert {r["id"]: r["shard"] for r in back} == want
    for k in range(4):
        assert sorted(r["slot"] for r in back if r["shard"] == k) == list(range(sum(r["shard"] == k for r in back)))


def test_nothing_and_wrong_law(nothing):
    assert of(nothing) == Counter()
    with pytest.raises(ValueError):
        sharded(nothing, ["doc_id"], "n", 8, "words")
