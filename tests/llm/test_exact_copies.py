import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from sievework.llm import common
from sievework.llm.exact_copies import drop_copies, exact_copies


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i != keep,)):
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
            first = False
    return sorted(out, key=repr)


def test_equals_brute_force(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    for size in (64 << 20, 512):  # a filter that is full passes more rows, with the same result
        got = exact_copies(odd, filter_bytes=size).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
        assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_stage_keeps_one_of_each_text_whole(odd, nothing):
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    texts = [r["text"] or "" for r in odd.collect()]
    assert sorted(t for _, t in rows) == sorted(set(texts))
    assert drop_copies(nothing).count() == 0 and exact_copies(nothing).count() == 0


def test_hot_group_meets_where_it_lies(spark, monkeypatch):
    from sievework.llm import exact_copies as module
    monkeypatch.setattr(module, "join_groups", lambda *a: common.join_groups(*a, least=10))
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 150)).alias("text"))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in module.exact_copies(df).collect()}
    assert len(got) == 300 and all(got[i] == (99, 100, i == 99) for i in range(100))
    assert got[299] == (299, 2, True) and got[149] == (299, 2, False) and got[120] == (270, 2, False)
