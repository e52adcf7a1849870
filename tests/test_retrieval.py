"""Vector search against all products."""

import numpy as np
import pytest

from sievework.operators import retrieval


def made(n, spread, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(15, 8))[rng.integers(0, 15, n)] + spread * rng.normal(size=(n, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[3] = v[4]
    return v


@pytest.mark.parametrize("block_rows, slice", [(2048, 1024), (20, 7)])
def test_all_lists_are_exact_and_few_find_most(spark, monkeypatch, block_rows, slice):
    monkeypatch.setattr(retrieval, "SLICE", slice)
    v = made(400, 0.3, 1)
    df = spark.createDataFrame([(i, x.tolist(), f"s{i % 3}", f"text {i}\nmore") for i, x in enumerate(v)], "k long, v array<double>, source string, text string")
    index = retrieval.vector_index(df, "k", "v", 20)
    assert index.lists().agg({"rows": "sum"}).first()[0] == 400
    queries = df.filter("k % 10 = 0 or k = 3")
    s = np.round(np.clip(v @ v.T, -1, 1), 9)
    exact = retrieval.search(index, queries, "k", "v", 5, block_rows=block_rows, skip_same=True)
    got = {(r["query"], r["rank"]): (r["id"], r["score"]) for r in exact.collect()}
    for q in [*range(0, 400, 10), 3]:
        want = sorted((-s[q, j], j) for j in range(400) if j != q)[:5]
        assert [got[q, r][0] for r in range(1, 6)] == [j for _, j in want]
        assert [got[q, r][1] for r in range(1, 6)] == pytest.approx([-x for x, _ in want])
    some = retrieval.search(index, queries, "k", "v", 5, 4, block_rows, True)
    r = retrieval.recall(some, exact).first()
    assert r["answers"] == 205 and 0.9 <= r["recall"] <= 1.0
    named = retrieval.with_sources(exact, df, "k", "text", "source").filter("query = 3 and rank = 1").first()
    assert (named["id"], named["source"], named["passage"]) == (4, "s1", "text 4 | more")
    own = retrieval.search(index, queries, "k", "v", 1, block_rows=block_rows).filter("query <> 3").collect()
    assert all(x["id"] == x["query"] for x in own)


def test_fewer_rows_than_lists(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "k long, v array<double>")
    found = retrieval.search(retrieval.vector_index(df, "k", "v", 64), df, "k", "v", 5).collect()
    assert {(r["query"], r["id"]) for r in found} == {(1, 1), (1, 2), (2, 1), (2, 2)}
