"""Spelling variants against a comparison of every pair of words."""

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest

from sievework.llm import spelling
from sievework.llm.spelling import Trie, _vectors, one_apart, spelling_variants, word_counts


def slow_words(rows, typos):
    counts = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if id is None else id}:{run}".encode())
            if typos and h % typos == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def variants(word, alphabet):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet} | {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return out - {word}


def slow(rows, typos):
    ns = slow_words(rows, typos)
    alphabet, out = sorted({c for w in ns for c in w}), {}
    for w, n in ns.items():
        near = [v for v in variants(w, alphabet) if v in ns] if len(w) < 100 else [v for v in ns if one_apart(w, v)]
        best = min(near, key=lambda v: (-ns[v], v), default=None)
        form = best if near and ns[best] >= 2 * n else None
        out[w] = [form, w, n, len(near), ns[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {(w, *row) for w, row in out.items()}


def of(df, **options):
    rows = spelling_variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_one_apart():
    words = ["".join(w) for k in range(4) for w in __import__("itertools").product("ab", repeat=k)]
    for a in words:
        for b in words:
            assert one_apart(a, b) == (b in variants(a, "ab"))


def test_trie_finds_what_the_budget_allows():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(600)})
    import numpy as np
    group_of = np.zeros(0x110000, np.uint8)
    for k, c in enumerate("abcdefgh"):
        group_of[ord(c)] = k % 5
    trie, own = Trie(words, group_of), _vectors(words, group_of)
    found = {(words[s], trie.words[w]) for a, b in trie.search(own) for s, w in zip(a, b)}
    gap = own[:, None] - own[None]
    want = (np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1)
    assert found == {(words[i], words[j]) for i, j in zip(*np.nonzero(want))}
    assert all((a, b) in found for a, b in combinations(words, 2) if one_apart(a, b))


def test_odd_documents(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for typos in (None, 5):
        want = slow(rows, typos)
        assert want and of(odd, typos=typos) == want


def test_chains_ties_and_hot_shards(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    monkeypatch.setattr(spelling, "SLICE", 64)
    rng = random.Random(3)
    base = "abcde"
    words = {base: 200, "abcdé": 90, "abcfé": 40, "abgfé": 10, "hbgfé": 4, "xbcde": 90, "abcd": 500, "abcdee": 3}
    for p in range(300):  # one shard of words of the same letters
        w = list("abcdeabcde")
        rng.shuffle(w)
        words["".join(w)] = rng.randint(1, 40)
    text = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(text)
    rows = [(k, " ".join(text[k::37])) for k in range(37)]
    got = of(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got == slow(rows, None)
    by = {r[0]: r for r in got}
    assert by["hbgfé"][2] == base and by["abcfé"][1] == "abcdé" and "abcd" not in by


def test_counts_pass_on_when_full(spark, odd, monkeypatch):
    want = {tuple(r) for r in word_counts(odd, typos=7).collect()}
    monkeypatch.setattr(spelling, "HELD", 3)
    assert {tuple(r) for r in word_counts(odd, typos=7).collect()} == want


def test_nothing(nothing):
    assert of(nothing) == set()


@pytest.mark.parametrize("text", ["", None, "ab cd"])
def test_no_words(spark, text):
    assert of(spark.createDataFrame([(1, text)], "doc_id long, text string")) == set()


def test_words_compared_by_the_thousand(monkeypatch):
    """Rows of letters against one comparison at a time, with words beyond the width."""
    monkeypatch.setattr(spelling, "WIDE", 6)
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(400)})
    import numpy as np
    for own, other in ((words[:200], words[200:]), (words, words), ([w for w in words if len(w) < 4], words)):
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(own)), np.arange(len(other))))
        got = set(spelling._verified((own, *spelling._letters(own)), (other, *spelling._letters(other)), iter([(i, j)])))
        assert got == {(x, y) for x in range(len(own)) for y in range(len(other)) if one_apart(own[x], other[y])}
