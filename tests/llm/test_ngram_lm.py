import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sievework.llm.elias_fano import Sequence, build
from sievework.llm.ngram_lm import Model, learn, score_texts, squeeze, unsqueeze


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (100, 100), (100, 10**6), (5000, 10**12), (3000, 2**61)])
def test_sequences(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n)).astype(np.uint64)
    s = Sequence(np.frombuffer(build(values, universe), np.uint64))
    assert (s.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe, 500).astype(np.uint64)])
    at, same = s.search(asked)
    assert (at == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()


def test_sequences_with_equal_values():
    values = np.sort(np.random.default_rng(1).integers(0, 50, 1000)).astype(np.uint64)
    s = Sequence(np.frombuffer(build(values, 50), np.uint64))
    assert (s.get(np.arange(1000)) == values).all()
    assert (s.search(np.arange(50, dtype=np.uint64))[0] == np.searchsorted(values, np.arange(50))).all()


def test_counts_squeezed():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 1000)).astype(np.uint64)
    got = unsqueeze(squeeze(keys, np.arange(len(keys))))
    assert (got[0] == keys).all() and (got[1] == np.arange(len(keys))).all()


def split(text):
    return [*re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


class Slow:
    """The same smoothing with dictionaries."""

    def __init__(self, texts):
        self.one = Counter(w for t in texts for w in t)
        self.total = sum(self.one.values())
        self.two = Counter(g for t in texts for g in zip([None, *t], t))
        self.three = Counter(((u, v), w) for t in texts for u, v, w in zip([None, *t], t, t[1:]))
        self.next2, self.next3 = Counter(u for u, _ in self.two), Counter(u for u, _ in self.three)
        self.d2, self.d3 = self.discount(self.two), self.discount(self.three)

    @staticmethod
    def discount(counts):
        once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        return once / (once + 2 * twice) if once and twice else 0.5

    def p1(self, w):
        return (self.one[w] + 0.1) / (self.total + 0.1 * (len(self.one) + 1))

    def p2(self, u, w):
        if not self.next2[u]:
            return self.p1(w)
        d = self.d2
        return (max(self.two[u, w] - d, 0) + d * self.next2[u] * self.p1(w)) / self.one[u]

    def p3(self, u, v, w):
        if not self.next3[u, v]:
            return self.p2(v, w)
        d = self.d3
        return (max(self.three[(u, v), w] - d, 0) + d * self.next3[u, v] * self.p2(v, w)) / self.two[u, v]

    def score(self, t, order):
        if order == 2:
            return sum(math.log10(self.p2(u, w)) for u, w in zip([None, *t], t))
        return math.log10(self.p2(None, t[0])) + sum(math.log10(self.p3(u, v, w)) for u, v, w in zip([None, *t], t, t[1:]))


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_brute_force(odd, order):
    rows = [(r["doc_id"], split(r["text"])) for r in odd.select("doc_id", "text").collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    slow = Slow([t for i, t in rows if not held(i)])
    got = sorted(score_texts(odd, order=order).collect(), key=repr)
    assert len(got) == len(rows) and any(r["held_out"] for r in got)
    texts = {i: t for i, t in rows}
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(t), sum(slow.one[w] > 0 for w in t), slow.total)
        assert r["base_score"] == pytest.approx(sum(math.log10(slow.p1(w)) for w in t), rel=1e-9)
        assert abs(r["score"] - slow.score(t, order)) <= 0.02 * len(t)


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = ["a b a c", "a b b", "c a"] * 3
    model = Model(*learn(spark.createDataFrame([(t,) for t in texts], "text string"), 2, 2))
    slow = Slow([split(t) for t in texts])
    level = model.levels[0]
    for context in range(model.words.size):
        word = np.arange(model.words.size)
        found, log_p = level.find(level.keys(np.full(len(word), context), word))
        left = model.backoff(2, np.array([context])) if level.continuations(np.array([context]))[0] else np.ones(1)
        p = np.where(found >= 0, 10 ** log_p, left * model.base(model.words.counts(word)))
        unknown = left[0] * model.base(np.zeros(1))[0]
        assert p.sum() + unknown == pytest.approx(1, abs=0.02)
    assert model.total == slow.total and model.words.size == len(slow.one)


def test_nothing_to_learn_from(spark, nothing):
    assert score_texts(nothing).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"], row["base_score"], row["score"]) == (0, 0, 3, 0.0, 0.0)


class SlowOfAnyOrder:
    """Interpolated discounting by recursion over whole grams; contexts reach back to the end before a text."""

    def __init__(self, texts, order):
        self.counts = [Counter(g for t in texts for g in zip(*([None, *t][k:] for k in range(n)))) for n in range(order + 1)]
        self.one = Counter(w for t in texts for w in t)
        self.next = [Counter(g[:-1] for g in c) for c in self.counts]
        self.d = [Slow.discount(c) for c in self.counts]

    def p(self, context, w):
        if not context:
            return (self.one[w] + 0.1) / (self.one.total() + 0.1 * (len(self.one) + 1))
        n = len(context) + 1
        if not self.next[n][context]:
            return self.p(context[1:], w)
        of = self.counts[n - 1][context] if n > 2 else self.one[context[0]]
        return (max(self.counts[n][(*context, w)] - self.d[n], 0) + self.d[n] * self.next[n][context] * self.p(context[1:], w)) / of

    def score(self, t, order):
        padded = [None, *t]
        return sum(math.log10(self.p(tuple(padded[max(0, i - order + 2):i + 1]), w)) for i, w in enumerate(t))


def test_orders_above_three_and_the_registered_order(spark, tmp_path):
    from sievework.llm.queries import op10_ngram_lm

    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(list("abcdefg"), 12)) + " of the end of the day") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {i: split(t) for i, t in rows}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    for order, got in ((4, score_texts(df, order=4)), (3, op10_ngram_lm(spark, str(tmp_path)))):
        slow = SlowOfAnyOrder(train, order)
        for r in got.collect():
            assert abs(r["score"] - slow.score(texts[r["doc_id"]], order)) <= 0.02 * r["n_tokens"]
