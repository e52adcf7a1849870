import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sievework.llm.packing import best_configuration, pack, places, plan, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def laid_out(histogram, capacity):
    """The sequences of a plan, checked for gaps."""
    bins = plan(histogram, capacity)
    key, each, base, offset = places(bins)
    filled = {}
    for length, count in histogram.items():
        rank = np.arange(count)
        run = np.searchsorted(key, (length << 48) + rank, side="right") - 1
        number = rank - (key[run] & ((1 << 48) - 1))
        for s, o in zip((base[run] + number // each[run]).tolist(), (offset[run] + number % each[run] * length).tolist()):
            filled.setdefault(s, []).append((o, length))
    for items in filled.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= capacity
    assert len(filled) == bins.total()
    return len(filled)


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_whole_and_near_the_bound(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 64, 100, 4096])
    histogram = {rng.randint(1, capacity): rng.randint(1, 60) for _ in range(rng.randint(1, 30))}
    used = laid_out(histogram, capacity)
    decreasing = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):  # best fit of single items
        room = min((r for r in decreasing if r >= n), default=None)
        if room is None:
            decreasing.append(capacity - n)
        else:
            decreasing[decreasing.index(room)] -= n
    assert used <= len(decreasing) * 1.02 + 1


def test_thirds_and_empty():
    assert laid_out({1366: 1000, 1365: 1000, 1400: 7}, 4096) <= 760
    assert plan({}, 4096).total() == 0
    value, counts = best_configuration(np.array([5, 3]), np.array([5.0, 3.1]), 11)
    assert counts.tolist() == [1, 2] and value == pytest.approx(11.2)


def test_documents(odd, nothing):
    library = Tokenizer.from_file(PATH)
    packed = pack(odd, PATH, 1)
    got = packed.collect()
    want = []
    for i, t in ((r["doc_id"], r["text"] or "") for r in odd.collect()):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in by.values():
        ends = [0, *np.cumsum([n for _, n in sorted(items)]).tolist()]
        assert [o for o, _ in sorted(items)] == ends[:-1] and ends[-1] <= 4096
    assert len(by) == -(-sum(n for *_, n, _ in want) // 4096)
    assert pack(nothing, PATH, 1).count() == 0


def test_sequences_hold_the_ids(odd):
    docs = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    library = Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    packed = pack(docs, PATH, 1).cache()
    whole = {r["sequence_id"]: r["ids"] for r in sequences(packed, docs, PATH, 1).collect()}
    for r in packed.collect():
        ids = [*library.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids[r["start"]:r["start"] + r["length"]]
