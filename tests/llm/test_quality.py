import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm.quality import D, FEATURES, PRIOR, blended, chi2_quantile, consistency, drop_poor, measure, quality_rules

from .conftest import sentence


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(words) < 400 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_counts(texts):
    for t in [*texts, "a b c a b c", "x x x x", "l\nl\n \n\nl", "a b c"]:
        counts = measure(t or "")[:5]
        assert counts == slow_counts(t)


def test_quantiles():
    assert chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert consistency(0.75) > 1 and consistency(1.0) == 1


def brute_estimate(x, part=0.75, steps=50):
    """Concentration steps on an array, with the same starting point and the bins' rounding left out."""
    floor = np.array(list(FEATURES.values()))
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="lower")
    center, precision = q[1], np.diag(1 / np.maximum((q[2] - q[0]) / 1.349, floor) ** 2)
    for _ in range(steps):
        gap = x - center
        d = np.einsum("ij,jk,ik->i", gap, precision, gap)
        near = x[np.argsort(d, kind="stable")[:int(np.ceil(part * len(x)))]]
        center = near.mean(axis=0)
        precision = np.linalg.inv(consistency(len(near) / len(x)) * np.cov(near.T, bias=True) + np.diag(floor ** 2))
    gap = x - center
    d = np.einsum("ij,jk,ik->i", gap, precision, gap)
    near = x[d <= chi2_quantile(0.975, D)]
    return near.mean(axis=0), np.cov(near.T, bias=True) + np.diag(floor ** 2)


def brute_distances(x, keys, own=25.0):
    """Distances from estimates of table, language and source, each weighed against the wider ones."""
    out = np.zeros(len(x))
    for key in set(keys):
        center, scatter = None, np.diag((PRIOR * np.array(list(FEATURES.values()))) ** 2)
        for level in range(3):
            rows = x[[k[:level] == key[:level] for k in keys]]
            c, s = brute_estimate(rows)
            if center is None:
                center = c
            w, gap = len(rows) ** 2 / (len(rows) ** 2 + own ** 2), c - center
            scatter = w * s + (1 - w) * scatter + w * (1 - w) * np.outer(gap, gap)
            center = w * c + (1 - w) * center
        at = [k == key for k in keys]
        gap = x[at] - center
        out[at] = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(scatter), gap)
    return out


def test_outliers_of_their_own_group(spark):
    rng = random.Random(3)
    rows = []
    for i in range(700):
        text = sentence(rng, rng.randint(60, 200))
        if i % 25 == 0:
            text = " ".join(w + "***" for w in text.split())
        rows.append((i, text, "en", "big" if i < 500 else f"small{i % 4}" if i < 690 else None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules(df).collect()}
    assert all(got[i]["kept"] == (i % 25 != 0) for i in range(700))
    slow = brute_distances(np.array([[got[i][f"x{k}"] for k in range(D)] for i in range(700)]), [(r[2], r[3]) for r in rows])
    fast = np.array([got[i]["distance"] for i in range(700)])
    assert np.corrcoef(np.log(slow + 1), np.log(fast + 1))[0, 1] > 0.99
    assert ((slow > chi2_quantile(1 - 1e-5, D)) == (fast > chi2_quantile(1 - 1e-5, D))).all()


def test_small_sources_are_judged_like_large_ones(spark):
    """The same outlier goes and the same clean text stays in sources of 1, 2, 5, 20 and 150 rows, and in a language of one row."""
    rng = random.Random(9)
    bad = " ".join(w + "***" for w in sentence(rng, 100).split())
    rows = [(f"s{n}", "en", sentence(rng, rng.randint(60, 200))) for n in (1, 2, 5, 20, 150) for _ in range(n - 1)]
    rows += [(f"s{n}", "en", bad) for n in (1, 2, 5, 20, 150)] + [("lone", "de", sentence(rng, 120)), ("lone", "fr", bad), (None, None, bad)]
    df = spark.createDataFrame([(i, t, lang, s) for i, (s, lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules(df).collect()}
    assert all(got[i]["kept"] == (t != bad) for i, (_, _, t) in enumerate(rows))


def test_few_rows_reject_little(spark):
    rng = random.Random(10)
    rows = [(i, sentence(rng, rng.randint(60, 90)) + "\nmenu\nmenu", "en", "s") for i in range(3)] + [(3, sentence(rng, 70), "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r["kept"] and r["distance"] is not None for r in quality_rules(df).collect())


def test_a_mixture_has_the_moments_of_its_rows():
    rng = np.random.default_rng(1)
    one, two = rng.normal(size=(30, D)), rng.normal(2.0, 3.0, size=(30, D))
    center, scatter = blended([(10 ** 9, one.mean(0), np.cov(one.T, bias=True)), (30, two.mean(0), np.cov(two.T, bias=True))], 30.0)
    both = np.concatenate([one, two])
    assert np.allclose(center, both.mean(0)) and np.allclose(scatter, np.cov(both.T, bias=True))


def test_odd_rows_and_stage(odd, nothing):
    got = quality_rules(odd).collect()
    assert len(got) == odd.count() and all(r["n_words"] < 50 or r["kept"] or 2 * r["n_repeat_words"] > r["n_words"] for r in got)
    poor = {r["doc_id"] for r in got if not r["kept"]}
    kept = drop_poor(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in odd.collect() if r["doc_id"] not in poor)
    assert quality_rules(nothing).count() == 0 and drop_poor(nothing).count() == 0


def test_each_statistic_alone_rejects(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.randint(90, 160))) for i in range(300)]
    passage = sentence(rng, 20)
    odd = {
        "word_length": " ".join(w * 2 for w in sentence(rng, 100).split()),
        "symbols": " ".join(w + "#" for w in sentence(rng, 100).split()),
        "dup_lines": "\n".join(f"{sentence(rng, 10)}\nmenu" for _ in range(12)),
        "repeats": " ".join([sentence(rng, 30), passage, sentence(rng, 30), passage]),
        "variety": " ".join(rng.choice("abc") + rng.choice("ddeeff") + "xy" for _ in range(100)),
    }
    assert set(odd) == set(FEATURES)
    rows += [(1000 + k, t) for k, t in enumerate(odd.values())]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules(df).collect()}
    assert [k for k, i in zip(odd, range(1000, 1005)) if got[i]["kept"]] == []
    assert not any(got[i]["base_failed"] for i in range(1000, 1005))
    assert all(got[i]["kept"] for i in range(300))
