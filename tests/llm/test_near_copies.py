import random
import re

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import near_copies as module
from sievework.llm.components import components
from sievework.llm.near_copies import drop_near_copies, estimate, near_copies, registers
from sievework.llm.shingles import shingle_sets

from .conftest import sentence


def slow_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def slow(rows, percent=85):
    """Sizes, components and kept rows by comparing all pairs."""
    sets = [slow_set(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(a):
        while part[a] != a:
            a = part[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                part[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k)), i == least.get(root(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_shingles_are_those_of_words(texts):
    for t, s in zip(texts, shingle_sets([(t or "").encode() for t in texts])):
        assert len(s) == len(slow_set(t)) and (np.diff(s.astype(object)) > 0).all()


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.85, 0.95):
        a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
        b = np.concatenate([a[:int(3000 * 2 * share / (1 + share))], rng.integers(0, 1 << 63, 3000, dtype=np.uint64)])[:3000]
        rows = registers([np.unique(a), np.unique(b)])
        got, _ = estimate(rows[0], rows[1:], 3000, np.array([3000]))
        assert abs(got[0] - share) < 5 * np.sqrt(share * (1 - share) / module.REGISTERS) + 0.01


def test_odd_documents(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, near_copies(odd).collect()), key=repr) == slow(rows)
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == sum(k for *_, k in slow(rows))
    assert near_copies(nothing).count() == 0


def test_group_of_near_copies_around_the_threshold(spark, monkeypatch):
    """A crowded band whose texts are linked only here and there, in cells of few rows."""
    monkeypatch.setattr(module, "BLOCK", 16)
    monkeypatch.setattr(module, "BAND_BLOCK", 16)
    rng = random.Random(9)
    words = sentence(rng, 150).split()
    rows = []
    for i in range(90):
        own = list(words)
        for k in rng.sample(range(len(own)), 3):
            own[k] = f"w{rng.randint(0, 400)}"
        rows.append((i, " ".join(own)))
        if i % 3 == 0:
            words[rng.randrange(len(words))] = f"v{i}"  # a chain whose ends are unlike
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_copies(df).collect()), key=repr) == slow(rows)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 140), 100)}


def test_bands_of_one_first_text_are_one(spark):
    """A crowd that meets in many bands goes into cells once for its first text; bands that share little stay apart."""
    crowd = [(key, node, (0, 9), 30) for key in range(100, 110) for node in range(30) if node == 0 or (node + key) % 10]
    apart = [(key, node, (40, 9), 4) for key in (200, 201) for node in (40, key, key + 10, key + 20)]
    members = spark.createDataFrame(crowd + apart + [(300, 50, (50, 9), 2), (300, 51, (50, 9), 2)], "key long, node long, pivot struct<node:long,width:long>, n long")
    got = sorted(map(tuple, module._crowds(members).collect()))
    assert got == sorted([(0, n) for n in range(30)] + [(k, n) for k, n, *_ in apart])


def test_a_crowd_of_texts_that_are_not_near_enough(spark):
    """Texts that share bands but no link, and a few copies among them: the same classes, whatever is sent."""
    rng = random.Random(4)
    words = sentence(rng, 200).split()
    rows = []
    for i in range(60):
        own = list(words)
        for k in rng.sample(range(len(own)), 7):
            own[k] = f"x{rng.randint(0, 10_000)}"
        rows.append((i, " ".join(own)))
    rows += [(100 + i, rows[i][1] + f" tail{i}") for i in range(0, 60, 4)]
    rows += [(200 + i, rows[i][1] + " and more words of another kind" * 30) for i in range(0, 60, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_copies(df, percent=80).collect()), key=repr) == slow(rows, 80)
