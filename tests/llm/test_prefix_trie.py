"""The prefix trie against one that holds every sequence as a tuple."""

import hashlib
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from sievework.llm import prefix_trie
from sievework.llm.prefix_trie import conversation_trie, packed


def slow(rows, rebuild):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:]) if rebuild else tuple(turns)
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
            leaves[p[:d]] += kids[p] == 0
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest()) for p, m in members.items())


SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, a string, n string"


def of(spark, rows, rebuild):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in conversation_trie(df, rebuild).collect())


def made(rng, convs, turns):
    rows = []
    for c in convs:
        for t in range(rng.randint(0, turns)):
            text = rng.choice(["a", "bb", "", None, "hello there", "é" * 5, str(rng.randint(0, 9))])
            rows.append((c, rng.choice([None, t, t, t]) if t == 0 else t, rng.choice(["user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_random_conversations(spark, rebuild):
    rng = random.Random(4)
    rows = made(rng, [*range(0, 60), *range(100, 130), *range(250, 260), 700], 7)
    rows += [(None, 1, "user", "nobody"), rows[0], rows[0]]
    assert of(spark, rows, rebuild) == slow(rows, rebuild)


def test_long_hot_and_split(spark, monkeypatch):
    for name, value in (("SEGMENT", 4), ("TOGETHER", 8), ("PIECE", 8)):
        monkeypatch.setattr(prefix_trie, name, value)
    rng = random.Random(5)
    same = [("user", "hi"), ("assistant", "hello")] * 3
    rows = [(c, t, *x) for c in range(0, 300, 2) for t, x in enumerate(same)]  # very many copies
    rows += [(c, t, *x) for c in range(1, 301, 4) for t, x in enumerate([*same[:rng.randint(1, 6)], ("user", str(c)), ("user", "z")])]
    rows += [(1001, t, "user", str(t % 3)) for t in range(400)]  # one long conversation
    rows += [(1002, t, "user", str(t % 3) if t < 300 else "x") for t in range(320)]
    for rebuild in (False, True):
        assert of(spark, rows, rebuild) == slow(rows, rebuild)


def test_nothing(spark):
    assert of(spark, [], True) == Counter()
    assert of(spark, [(None, 1, "user", "x")], True) == Counter()


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(101, 140)]  # no conversation to take a start from
    got = of(spark, rows, True)
    assert got == slow(rows, True) and sum(x[3] for x in got if x[1] == 0) == 39


def test_double_array():
    rng = random.Random(6)
    sequences = [np.array(x, np.int64) for x in sorted({tuple(rng.randint(0, 30) for _ in range(rng.randint(0, 9))) for _ in range(500)})]
    rng.shuffle(sequences)
    trie, ends = packed(sequences)
    prefixes = {tuple(s[:d]) for s in sequences for d in range(len(s) + 1)}
    assert (trie.check >= 0).sum() == len(prefixes) and len(set(ends.tolist())) == len(sequences)
    for s, end in zip(sequences, ends):
        node = 0
        for x in s.tolist():
            node = trie.child(node, x)
        assert node == end
    assert sum(trie.child(0, c) >= 0 for c in range(40)) == len({p[0] for p in prefixes if p})
