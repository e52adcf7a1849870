"""Coverage, allocation, review samples and exact quantiles against plain Python."""

import random
from collections import Counter
from hashlib import md5
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import review, stats

ROWS = [(i, ["a", "b", None][i % 3], ["x", "y"][i % 2 if i % 5 else 0], i % 4) for i in range(90) if (i % 3, i % 2) != (1, 1)]
SCHEMA = "id long, p string, q string, r int"


def test_coverage(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r["dimensions"]: (r["rows"], r["seen"], r["possible"], r["empty"], round(r["covered"], 9), r["largest"]) for r in review.coverage_matrix(df, ["p", "q", "r"]).collect()}
    names, want = ["p", "q", "r"], {}
    for k in range(4):
        for some in combinations(range(3), k):
            cells = Counter(tuple(row[1 + i] for i in some) for row in ROWS)
            possible = int(np.prod([len({row[1 + i] for row in ROWS}) for i in some]))
            want[",".join(names[i] for i in some)] = (len(ROWS), len(cells), possible, possible - len(cells), round(len(cells) / possible, 9), max(cells.values()))
    assert got == want
    gaps = {tuple(r) for r in review.empty_cells(df, ["p", "q"]).collect()}
    assert gaps == set(product({r[1] for r in ROWS}, {r[2] for r in ROWS})) - {r[1:3] for r in ROWS}
    assert review.coverage_matrix(df.filter("id < 0"), ["p", "q"]).filter("seen > 0 and dimensions <> ''").count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 30, 1000])
def test_review_sample(spark, n):
    df = spark.createDataFrame(ROWS, SCHEMA)
    sizes, total = Counter(r[1:3] for r in ROWS), len(ROWS)
    m = min(n, total)
    take = {s: c * m // total for s, c in sizes.items()}
    order = sorted(sizes, key=lambda s: (-(sizes[s] * m % total), s[0] is not None, s[0] or "", s[1]))
    for s in order[:m - sum(take.values())]:
        take[s] += 1
    want = {(r[0], place) for s in sizes for place, r in enumerate(sorted((r for r in ROWS if r[1:3] == s), key=lambda r: (md5(f"42|{r[0]}".encode()).hexdigest(), r[0]))[:take[s]], 1)}
    got = review.review_sample(df, "id", ["p", "q"], n)
    assert {(r["id"], r["place"]) for r in got.collect()} == want and len(want) == m
    assert got.columns == [*df.columns, "place"]


@pytest.mark.parametrize("ordered, accuracy", [(20_000, 10_000), (5, 10), (1, 200)])
def test_exact_quantiles(spark, monkeypatch, ordered, accuracy):
    monkeypatch.setattr(stats, "ORDERED", ordered)
    monkeypatch.setattr(stats, "ACCURACY", accuracy)
    rng = random.Random(7)
    distinct = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 9) for _ in range(700)]
    hot = [rng.choice([0.5, 0.5, 0.5, rng.random()]) for _ in range(700)]
    rows = [(a, b, None, 3 if k == 5 else None) for k, (a, b) in enumerate(zip(distinct, hot))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.77, 1.0]
    got = stats.exact_quantiles(df, ["a", "b", "c", "d"], shares)
    for name, values in (("a", distinct), ("b", hot)):
        for q in shares:
            assert got[name, q] == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert all(got["c", q] is None and got["d", q] == 3 for q in shares)


def test_describe_scores(spark):
    df = spark.createDataFrame([(float(i), i % 4) for i in range(101)], "x double, y int")
    rows = {r["metric"]: r for r in stats.describe_scores(df, ["x", "y"]).collect()}
    assert (rows["x"]["p25"], rows["x"]["p50"], rows["x"]["p75"], rows["x"]["max"], rows["x"]["count"]) == (25.0, 50.0, 75.0, 100.0, 101)
    assert rows["y"]["std"] == pytest.approx(np.std([i % 4 for i in range(101)], ddof=1))
    assert stats.describe_scores(df.withColumn("x", F.lit(None).cast("double")), ["x"]).first()["p50"] is None


def test_class_order_keeps_names_behind_any_number():
    assert stats.class_order(["x", "120", "12", "7", "b"]) == ["7", "12", "120", "x", "b"]
