"""Spelling variants: words one letter apart, found in tries of letter-group counts.

The letters of all words are dealt into twelve groups of about equal frequency. A word's count vector
says how many of its letters lie in each group. Words that one inserted, deleted or replaced letter
separates have vectors with a surplus of at most one letter and a deficit of at most one. So the
words are arranged in tries by their lengths and their successive counts, and a depth-first search from
a word's own vector spends a budget of one surplus and one deficit; the words of the leaves it
reaches are compared letter by letter.

The first levels (length and three counts) cut the trie into shards. A word is sent to its own shard and to
those of larger keys that the budget can reach, eleven at most, whatever the number of words; a pair is found once. A
shard of many words is cut into blocks, and its searches into slices, so a task holds at most
``BLOCK`` words of a trie and ``SLICE`` searches at once. Only counts and the best neighbour of each word leave a cell.

``word_counts`` reads whole texts: maximal runs of letters, ASCII letters lower-cased. With ``typos`` one run in so
many, chosen by the CRC-32 of ``<doc_id>:<run>``, loses one letter, which plants variants.

Defined results: a null text has no runs; a null id counts as the empty string; repeated rows and ids count
row by row; a text is held whole by one task, so its size is bounded by a task's memory; ties between
neighbours go to the first in code-point order; an empty table gives an empty result; other columns are not read. A word without
neighbours has ``n_near`` 0, no form, and is its own root.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import byte_texts, documents_of, join_groups, landed, sliced

LETTERS = "A-Za-zÀ-ÿ"
GROUPS = 16
#: Counts that, with the length, name a shard.
LEVELS = 3
#: Words of one trie, and searches that one copy of it serves.
BLOCK, SLICE = 2_048, 8_192
#: A node of so few words is a leaf.
LEAF = 16
#: Words of at most so many letters are compared by the thousand, longer ones singly.
WIDE = 32
COMPARED = 1 << 16
#: Counts held by a task before they are passed on, and their letters.
HELD, HELD_LETTERS = 200_000, 8_000_000


def _run_counts(letters: str, typos: int | None, least: int) -> Callable:
    """Counts of the runs of a task's texts, passed on whenever they fill its memory."""
    find = re.compile(f"[{letters}]{{{least},}}").findall

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = Counter(), 0
        for batch in sliced(batches):
            for id, text in zip(batch.column(0).to_pylist(), byte_texts(batch)):
                own = Counter(find(text.lower().decode("utf-8", "replace")))  # bytes lower only ASCII letters
                if typos:
                    start = crc32(f"{'' if id is None else id}:".encode())
                    for run in [run for run in own if crc32(run.encode(), start) % typos == 0]:
                        at = crc32(run.encode(), start) % len(run)
                        n = own.pop(run)
                        if len(run) > least:
                            counts[run[:at] + run[at + 1:]] += n
                counts.update(own)
                held += sum(map(len, own))  # at least the letters of the runs held
                if len(counts) > HELD or held > HELD_LETTERS:
                    yield out(counts)
                    counts, held = Counter(), 0
        yield out(counts)

    return task


def word_counts(df: DataFrame, id: str = "doc_id", text: str = "text", letters: str = LETTERS, typos: int | None = None,
                least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """``word`` and ``n`` of all words of at least so many letters and occurrences."""
    docs = documents_of(df, id, text)
    counts = docs.mapInArrow(_run_counts(letters, typos, least_letters), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_groups(words: DataFrame) -> list[str]:
    """The letters of each group: frequent ones first, each to the group with the fewest occurrences.

    One count per different letter comes to the driver: as many as the alphabet has.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    groups, sums = [""] * GROUPS, [0] * GROUPS
    for letter, n in sorted(letters.collect(), key=lambda x: (-x[1], x[0])):
        if letter:
            g = sums.index(min(sums))
            groups[g] += letter
            sums[g] += n
    return groups


def _vectors(words: list[str], group_of: np.ndarray) -> np.ndarray:
    """Counts of letters by group, a row per word; above a thousand all count alike, which only brings more to compare."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * GROUPS + group_of[points], minlength=len(words) * GROUPS)
    return np.minimum(counts, 1_000).astype(np.int16).reshape(len(words), GROUPS)


class Trie:
    """Words by the counts of successive groups; a node is a run of the words in the order of their vectors."""

    def __init__(self, words: list[str], group_of: np.ndarray):
        vectors = _vectors(words, group_of)
        order = np.lexsort(vectors.T[::-1])
        self.words, self.vectors = [words[k] for k in order], vectors[order]
        self.root = self._node(0, len(words), 0)

    def _node(self, start: int, end: int, level: int) -> tuple:
        """``(start, end, level, children)``; children are counts with nodes, none at a leaf."""
        if end - start <= LEAF or level == GROUPS:
            return start, end, level, ()
        column = self.vectors[start:end, level]
        edges = [start, *(start + 1 + np.flatnonzero(np.diff(column))), end]
        return start, end, level, [(int(self.vectors[a, level]), self._node(a, b, level + 1)) for a, b in zip(edges, edges[1:])]

    def search(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of searches and words whose vectors differ by at most one surplus and one deficit."""
        every, zero = np.arange(len(vectors)), np.zeros(len(vectors), np.int16)
        stack = [(self.root, every, zero, zero)]
        while stack:
            (start, end, level, children), alive, surplus, deficit = stack.pop()
            for count, child in children:
                gap = vectors[alive, level] - count
                more, less = surplus + np.maximum(gap, 0), deficit + np.maximum(-gap, 0)
                within = (more <= 1) & (less <= 1)
                if within.any():
                    stack.append((child, alive[within], more[within], less[within]))
            if not children and len(alive):
                gap = vectors[alive, None, level:] - self.vectors[None, start:end, level:]
                up, all_ = np.maximum(gap, 0).sum(2, dtype=np.int16), gap.sum(2, dtype=np.int16)
                more, less = surplus[:, None] + up, deficit[:, None] + up - all_
                searches, found = np.nonzero((more <= 1) & (less <= 1))
                yield alive[searches], found + start


def one_apart(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point separates two words."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word, padded with zeros (words longer than ``WIDE`` are cut), and the lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    short = np.minimum(lengths, WIDE)
    points = np.frombuffer("".join([w[:WIDE] for w in words]).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(words), int(short.max(initial=0)) + 1), np.min_scalar_type(int(points.max(initial=0))))
    out[np.arange(out.shape[1]) < short[:, None]] = points
    return out, lengths


def _one_longer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a letter less makes the right word the left one: they agree up to a place and, one apart, after it."""
    a = a[:, :b.shape[1] - 1] if a.shape[1] >= b.shape[1] else np.pad(a, ((0, 0), (0, b.shape[1] - 1 - a.shape[1])))
    shifted = a != b[:, 1:]
    last = np.where(shifted.any(1), shifted.shape[1] - 1 - shifted[:, ::-1].argmax(1), -1)
    differ = a != b[:, :-1]
    return last < np.where(differ.any(1), differ.argmax(1), differ.shape[1])


def _verified(searches: tuple, words: tuple, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """The candidates that are one letter apart. ``searches`` and ``words``: strings, letters and lengths."""
    (own, own_letters, own_lengths), (other, other_letters, other_lengths) = searches, words
    both = min(own_letters.shape[1], other_letters.shape[1])
    for s, w in found:
        for at in range(0, len(s), COMPARED):
            i, j = s[at:at + COMPARED], w[at:at + COMPARED]
            gap = other_lengths[j] - own_lengths[i]
            wide = np.maximum(own_lengths[i], other_lengths[j]) > WIDE
            good = np.zeros(len(i), bool)
            for kind in (0, 1, -1):
                k = np.flatnonzero((gap == kind) & ~wide)
                if len(k) == 0:
                    continue
                a, b = own_letters[i[k]], other_letters[j[k]]
                if kind == 0:
                    good[k] = np.count_nonzero(a[:, :both] != b[:, :both], axis=1) == 1
                else:
                    good[k] = _one_longer(a, b) if kind == 1 else _one_longer(b, a)
            good[wide] = [one_apart(own[x], other[y]) for x, y in zip(i[wide].tolist(), j[wide].tolist())]
            yield from zip(i[good].tolist(), j[good].tolist())


def _together(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of several leaves at once."""
    held, n = [], 0
    for pair in found:
        held.append(pair)
        n += len(pair[0])
        if n >= COMPARED:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _cells(group_of: np.ndarray) -> Callable:
    """Neighbours within sorted cells: the words of a block come first and are held; searches pass by in batches."""
    schema = ["word", "n_near", "best_n", "best"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, words, ns, trie, n_of, members = None, [], [], None, {}, ()
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            side = batch.column(3).to_numpy()
            texts, counts = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1] or side[k] > side[k - 1] == 0), len(keys)]
            near: dict[str, list] = {}

            def add(word: str, n: int, other: str) -> None:
                held = near.setdefault(word, [0, -n, other])
                held[0] += 1
                held[1:] = min(held[1:], [-n, other])

            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if keys[a] != cell:
                    cell, words, ns, trie = keys[a], [], [], None
                if side[a] == 0:
                    words += texts[a:b]
                    ns += counts[a:b]
                    continue
                if trie is None:
                    trie, n_of = Trie(words, group_of), dict(zip(words, ns))
                    members = trie.words, *_letters(trie.words)
                found = _together(trie.search(_vectors(texts[a:b], group_of)))
                for s, w in _verified((texts[a:b], *_letters(texts[a:b])), members, found):
                    own, other = texts[a + s], trie.words[w]
                    add(own, n_of[other], other)
                    if side[a + s] == 2:  # the other word does not search here
                        add(other, counts[a + s], own)
            if near:
                yield pa.record_batch([pa.array(near.keys(), pa.string()), pa.array([x[0] for x in near.values()], pa.int64()),
                                       pa.array([-x[1] for x in near.values()], pa.int64()), pa.array([x[2] for x in near.values()], pa.string())], names=schema)

    return task


def _reached() -> list[tuple[int, ...]]:
    """Steps of length and first counts to the shards of larger keys that one surplus and one deficit reach, its own first."""
    unit = lambda i, by: tuple(by * (i == j) for j in range(LEVELS))
    none = (0,) * LEVELS
    up = [unit(i, 1) for i in range(LEVELS)]
    both = [tuple(x + y for x, y in zip(unit(i, 1), unit(j, -1))) for i in range(LEVELS) for j in range(i + 1, LEVELS)]
    return [(0, *step) for step in (none, *up, *both)] + [(1, *step) for step in (none, *up)]


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the best neighbour ``near``, ``near_n`` (largest n, first in code-point order) of words with neighbours.

    ``words``: different words and their ``n`` (a landed table).
    """
    groups = letter_groups(words)
    group_of = np.zeros(0x110000, np.uint8)
    for g, letters in enumerate(groups):
        group_of[[ord(c) for c in letters]] = g

    def count(g: int) -> Column:
        return F.length("word") - F.length(F.translate("word", groups[g], "")) if groups[g] else F.lit(0)

    placed = words.select("word", "n", F.array(F.length("word"), *[count(g) for g in range(LEVELS)]).alias("at"))
    key = lambda at: F.array_join(F.transform(at, lambda x: x.cast("string")), ".")
    steps = F.array(*[F.array(*[F.lit(x) for x in step]) for step in _reached()])
    members = placed.select(key(F.col("at")).alias("shard"), "word", "n")
    searches = placed.select("word", "n", F.posexplode(steps).alias("step", "by"), "at").select(
        "word", "n", F.when(F.col("step") == 0, 1).otherwise(2).alias("side"), F.zip_with("at", "by", lambda a, b: a + b).alias("at")).filter(
        ~F.exists("at", lambda x: x < 0)).select(key(F.col("at")).alias("shard"), "side", "word", "n")
    total = words.count()
    held = members.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    asked = searches.groupBy("shard").agg(F.count(F.lit(1)).alias("asked"))
    sizes = landed(held.join(asked, "shard").select(
        "shard", (F.col("held") + F.col("asked")).alias("rows"), F.ceil(F.col("held") / F.lit(BLOCK)).cast("int").alias("blocks"),
        F.ceil(F.col("asked") / F.lit(SLICE)).cast("int").alias("slices")), "shards")

    def dealt(rows: DataFrame, side: Column, block: Column, slice: Column) -> DataFrame:
        met = join_groups(rows, sizes, "shard", "rows", (len(_reached()) + 1) * total)
        return met.withColumn("block", block).withColumn("slice", slice).select("shard", "block", "slice", side.cast("int").alias("side"), "word", "n")

    here = lambda count: F.pmod(F.xxhash64("word"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    cells = dealt(members, F.lit(0), here("blocks"), every("slices")).unionByName(dealt(searches, F.col("side"), every("blocks"), here("slices")))
    found = cells.repartition("shard", "block", "slice").sortWithinPartitions("shard", "block", "slice", "side").mapInArrow(
        _cells(group_of), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.best").alias("near"), (-F.col("b.n")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, where following ``form`` ends, of every word that has a form; each round doubles the steps taken."""
    now = landed(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = landed(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def spelling_variants(df: DataFrame, id: str = "doc_id", text: str = "text", typos: int | None = None, ratio: int = 2, **limits) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``form`` is the most frequent neighbour if it occurs at least ``ratio`` times as often as the word.
    """
    words = landed(word_counts(df, id, text, typos=typos, **limits), "words")
    met = words.join(near_words(words), "word", "left")
    formed = F.col("near_n") >= ratio * F.col("n")
    known = landed(met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("near")).alias("form"),
        F.when(formed, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(known.filter("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
