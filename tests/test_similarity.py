import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sievework.operators import cells, cluster, similarity, tfidf


def unit(n, d, seed):
    v = np.random.default_rng(seed).normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("n, block_rows", [(2, 2048), (37, 5), (90, 2048), (90, 16)])
def test_pair_stats_equal_the_full_matrix(spark, n, block_rows):
    v = unit(n, 6, n)
    s = (v @ v.T)[np.triu_indices(n, 1)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = similarity.pair_stats(df, "id", "v", block_rows=block_rows).first().asDict()
    want = {
        "n_pairs": len(s), "mean": s.mean(), "std": s.std(), "median": np.median(s), "p95": np.percentile(s, 95),
        "p99": np.percentile(s, 99), "min": s.min(), "max": s.max(), "share_gt_70": (s > 0.7).mean(),
        "share_gt_80": (s > 0.8).mean(), "share_gt_85": (s > 0.85).mean()}
    assert got == pytest.approx(want, abs=1e-8)
    linear = similarity.cosine_moments(df, "v").first().asDict()
    assert linear == pytest.approx({k: want[k] for k in ("n_pairs", "mean", "std")}, abs=1e-7)
    assert similarity.mean_cosine(df, "v").first()["mean"] == pytest.approx(s.mean(), abs=1e-9)


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(40, [0.0, 1.0])]
    got = similarity.pair_stats(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", block_rows=8).first()
    assert got["n_pairs"] == 820 and got["max"] == 1.0 and got["min"] == 0.0
    assert got["median"] == pytest.approx(1.0, abs=1e-8) and got["share_gt_85"] == pytest.approx(780 / 820)


def test_top_pairs_and_ties(spark):
    v = np.round(unit(60, 3, 5), 1)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = sorted((-round(min(1.0, float(v[i] @ v[j])), 9), i, j) for i in range(60) for j in range(i + 1, 60))[:20]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = similarity.top_pairs(df, "id", "v", 20, block_rows=7).orderBy("rank").collect()
    assert [(r["i"], r["j"]) for r in got] == [(i, j) for _, i, j in want]
    assert [r["rank"] for r in got] == list(range(1, 21))


def reference_tfidf(texts, most):
    grams = [t.split() + [" ".join(p) for p in zip(t.split(), t.split()[1:])] for t in texts]
    total, df = Counter(g for row in grams for g in row), Counter(g for row in grams for g in set(row))
    top = sorted(total, key=lambda g: (-total[g], g))[:most]
    m = np.array([[row.count(g) * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g in top] for row in grams])
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(size == 0, 1, size)


def test_tfidf_with_empty_texts_and_a_small_vocabulary(spark):
    texts = ["a b c", "a b d", "", "e f", "a a a b", "g", "b c d e"]
    for most in (4, 100):
        m = reference_tfidf(texts, most)
        s = (m @ m.T)[np.triu_indices(len(texts), 1)]
        df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
        got = tfidf.tfidf_pair_stats(df, "text", "id", most=most).first()
        assert got["n_pairs"] == len(s)
        for name, value in (("mean", s.mean()), ("std", s.std()), ("median", np.median(s)), ("p95", np.percentile(s, 95)), ("max", s.max())):
            assert got[name] == pytest.approx(value, abs=1e-8), (most, name)
        assert tfidf.tfidf_mean_cosine(tfidf.tfidf(df, "text", "id", most=most)).first()["mean"] == pytest.approx(s.mean(), abs=1e-9)


def sparse_table(rows, low, high):
    return pa.table({
        "p": pa.array([sorted(x) for x in rows], pa.list_(pa.int32())), "w": pa.array([[x[k] for k in sorted(x)] for x in rows], pa.list_(pa.float64())),
        "_low": pa.array(low), "_high": pa.array(high)})


@pytest.mark.parametrize("terms", [30, 400, 200_000])
def test_sparse_products_equal_the_full_matrix(terms):
    rng = np.random.default_rng(terms)
    rows = [{int(t): float(rng.random()) for t in np.minimum(rng.zipf(1.3, 25), terms) - 1} for _ in range(150)]
    rows[4] = rows[120] = {}
    m = np.zeros((150, terms))
    for i, x in enumerate(rows):
        m[i, list(x)] = list(x.values())
    side = np.arange(150) < 70
    found = list(cells.sparse_products(sparse_table(rows, side, ~side), "p", "w"))
    assert all(counts is None for _, _, counts in found) and np.allclose(np.concatenate([v for _, v, _ in found]), m[:70] @ m[70:].T, atol=1e-12)
    (_, values, counts), = cells.sparse_products(sparse_table(rows, [True] * 150, [True] * 150), "p", "w")
    assert np.allclose(values, m @ m.T, atol=1e-12) and counts.sum() == 150 * 149 // 2


def test_pair_stats_take_no_columns_for_rare_terms(spark):
    """Of 40,000 terms that few rows share, no cell makes a dense matrix."""
    rng = np.random.default_rng(7)
    rows = [{int(t): 0.2 for t in rng.choice(40_000, 25, replace=False)} for _ in range(1_200)]
    m = np.zeros((1_200, 40_000), np.float32)
    for i, x in enumerate(rows):
        m[i, list(x)] = 0.2
    df = spark.createDataFrame([(i, sorted(x), [x[k] for k in sorted(x)]) for i, x in enumerate(rows)], "id long, p array<int>, w array<double>")
    s = (m @ m.T)[np.triu_indices(1_200, 1)]
    got = similarity.pair_stats(df, "id", "p", weights="w").first()
    assert got["mean"] == pytest.approx(float(s.mean()), abs=1e-6) and got["max"] == pytest.approx(float(s.max()), abs=1e-6)
    table = sparse_table(rows, [True] * 1_200, [True] * 1_200)
    tracemalloc.start()
    for _ in similarity._products(table, "p", "w"):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # 1,200 x 25,000 columns would be 240 MB


def test_a_task_adds_its_cells_up(spark):
    """Cells of a bucket leave their task as one row, and buckets beyond the most that are held leave early."""
    rows = spark.range(400).selectExpr("id", "id % 5 as g").withColumn("_blocks", similarity.F.lit(8))
    groups = spark.range(5).selectExpr("id as g", "8 as _blocks")
    work = cells.Totals(["g"], lambda t: [0, 0], lambda s, t: s.__setitem__(slice(None), [s[0] + 1, s[1] + t.num_rows]),
                        lambda s, g: iter([pa.RecordBatch.from_arrays([pa.array([g[0].as_py()], pa.int64()), pa.array([s[0]]), pa.array([s[1]])], names=["g", "cells", "rows"])]), 2)
    found = cells.Buckets(rows, groups, ["g"], "_blocks", "id").run(work, "g long, cells long, rows long").collect()
    total = {g: (sum(r["cells"] for r in found if r["g"] == g), sum(r["rows"] for r in found if r["g"] == g)) for g in range(5)}
    assert total == {g: (36, 80 * 8) for g in range(5)} and len(found) < 5 * 36


def test_kmeans_report_and_plane(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(c, 0.01, size=(15, 3)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    rows = cluster.kmeans_report(df, "id", "v", ks=(3, 40), restarts=3).collect()
    assert {r["k"] for r in rows} == {3} and sorted(r["size"] for r in rows) == [15, 15, 15]
    assert rows[0]["silhouette"] > 0.99 and rows[0]["intra_mean"] < 0.1 < rows[0]["inter_mean"]
    assert cluster.kmeans_report(df.filter("id < 3"), "id", "v", ks=(3,)).count() == 0
    p = cluster.plane(df, "id", "v").orderBy("id").toPandas()[["x", "y"]].to_numpy()
    c = v - v.mean(0)
    w = np.linalg.svd(c, full_matrices=False)
    want = c @ w[2][:2].T
    assert np.allclose(np.abs(p[:, 0]), np.abs(want[:, 0]), atol=1e-6)


def test_regions_lose_no_pair(spark):
    """Best pairs and shares over clustered, equal, zero and opposite vectors with many small regions."""
    from sievework.operators import regions as r

    rng = np.random.default_rng(2)
    v = rng.normal(size=(12, 5))[rng.integers(0, 12, 400)] + 0.3 * rng.normal(size=(400, 5))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[3], v[5], v[9] = 0.0, v[4], -v[4]
    df = spark.createDataFrame([(i, "x" if i % 3 else None, x.tolist()) for i, x in enumerate(v)], "id long, g string, v array<double>")
    dealt = r.regions(df.selectExpr("id", "1 as _all", "v"), ["_all"], "id", "v", 32, 20, 10)
    closest, least = similarity.regions_best(dealt, "id", similarity.each_cell(similarity._best("id", "v", None, 30)), 30)
    s = np.round(np.clip(v @ v.T, -1, 1), 9)
    want = sorted((-s[i, j], i, j) for i in range(400) for j in range(i + 1, 400))[:30]
    assert [(x["i"], x["j"]) for x in closest.orderBy(-closest["score"], "i", "j").collect()] == [(i, j) for _, i, j in want]
    assert least == pytest.approx(-want[-1][0]) and dealt.work(least).first()["skipped"] > 0
    for by in ([], ["g"]):
        got = {x["g"] if by else 0: x.asDict() for x in similarity.shares_above(df, "id", "v", by, block_rows=32).collect()}
        for g in ({"x", None} if by else {0}):
            of = [i for i in range(400) if not by or (i % 3 > 0) == (g == "x")]
            p = (v[of] @ v[of].T)[np.triu_indices(len(of), 1)]
            assert got[g]["n_pairs"] == len(p)
            assert [got[g][c] for c in similarity.SHARES] == pytest.approx([(p > t).mean() for t in similarity.SHARES.values()], abs=1e-12)


def test_kmeans_costs_no_more_than_the_library_and_few_passes(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans

    rng = np.random.default_rng(4)
    v = rng.normal(size=(25, 6))[rng.integers(0, 25, 600)] * 3 + rng.normal(size=(600, 6))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    passes = []
    monkeypatch.setattr(cluster, "_grouped", lambda *a, real=cluster._grouped: (passes.append(1), real(*a))[1])
    models = cluster.kmeans(df, "id", "v", [5, 25], restarts=4)
    assert len(passes) <= cluster.ROUNDS + cluster.STEPS + 2
    rows = cluster._vectors(df, "id", "v")
    for k, (cost, centres) in models.items():
        gaps = ((v[:, None] - centres[None]) ** 2).sum(2)
        assert cost == pytest.approx(gaps.min(1).sum()) and len(centres) == k
        library = min(KMeans(k=k, seed=s, featuresCol="features").fit(rows).summary.trainingCost for s in range(2))
        assert cost <= 1.05 * library
        got = {r["id"]: (r["cluster"], r["away"]) for r in cluster.kmeans_clusters(df, "id", "v", {k: (cost, centres)}).collect()}
        assert all(got[i][0] == gaps[i].argmin() and got[i][1] == pytest.approx(np.sqrt(gaps[i].min())) for i in range(600))


def test_mean_cosine_takes_texts_apart_once_more(spark):
    """Beside the vocabulary, which is written, the terms are made once, and only known ones are counted in a text."""
    df = spark.createDataFrame([(i, f"a b{i % 3} c") for i in range(30)], "id long, text string")
    found = tfidf.tfidf_mean_cosine(tfidf.tfidf(df, "text", "id"))
    got, plan = found.first(), found._jdf.queryExecution().optimizedPlan().toString()
    assert got["n_pairs"] == 435 and 0 < got["mean"] < 1
    assert plan.count("Generate ") == 3  # places of words, terms of a place, cells of a row
