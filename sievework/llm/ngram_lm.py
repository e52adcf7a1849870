"""N-gram language models in Elias-Fano tries, learnt from a corpus and applied to all of its texts.

The first level is the vocabulary: the hashes of the training tokens in rising order, with their counts; the place of a
word is its number. A level above holds the n-grams of its order as a rising sequence of context times vocabulary
plus word, where the context is the place of the first words in the level below, so a word is looked up relative to
its context by a successor search. Rising pointers give the range of each context and so the number of its
continuations. Beside them lie the log probabilities in 256 steps of equal width per part, smoothed by interpolated absolute
discounting: (c - D) / c(context) plus D * continuations / c(context) times the probability without the first word;
below the bigrams stands (c + 0.1) / (N + 0.1 (V + 1)). D follows from the n-grams of each level that occur once and twice.

Levels are files in the shared folder, cut by ranges of keys; contexts that are frequent are cut further by the
following word, so no part grows with one of them. Tasks map the files they need into memory and count
or look up the sorted different keys of a slice of texts. Partial counts meet by part, compressed.

Tokens are told apart by 64-bit hashes. Defined results: a null text is empty and consists of the end alone; a null id is
in training; without training texts every token has probability 1; rows that repeat an id are learnt and scored each; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import byte_texts, landed, shared, sliced
from .elias_fano import Sequence, build
from .files import create, mapped
from .shingles import word_hashes

END = np.uint64(0x5EED0000E0D0E0D1)
ADDED = 0.1
#: Different keys that a task collects before it hands them on.
HELD = 4_000_000


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the end of each text, and the bounds of the texts."""
    words, bounds = word_hashes([t.lower() for t in texts])
    return np.insert(words, bounds[1:], END), bounds + np.arange(len(bounds))


def squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising keys and their counts, as differences by byte planes, compressed."""
    planes = np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(keys).to_bytes(8, "little") + pa.compress(
        planes + np.ascontiguousarray(counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=16 * n, codec="zstd", asbytes=True), np.uint8).reshape(2, 8, n)
    deltas, counts = (np.ascontiguousarray(p.T).view(np.uint64)[:, 0] for p in planes)
    return np.cumsum(deltas, dtype=np.uint64), counts


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class Tally:
    """Counts of keys, combined whenever enough are held."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if len(self.parts) > 1 and self.held > 2 * HELD:
            self.parts = [self.total()]
            self.held = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))


def counted(docs: DataFrame, keys_of: Callable[[], Callable[[list[bytes]], np.ndarray]], cuts: np.ndarray) -> DataFrame:
    """Partial counts of the keys of all texts: ``part`` (by ``cuts``, the first keys of all parts but the first) and ``data``."""
    def rows(tally: Tally) -> pa.RecordBatch:
        keys, counts = tally.total()
        bounds = np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])
        some = np.flatnonzero(np.diff(bounds))
        return pa.record_batch({"part": pa.array(some, pa.int32()), "data": pa.array(
            [squeeze(keys[bounds[p]:bounds[p + 1]], counts[bounds[p]:bounds[p + 1]]) for p in some], pa.binary())})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, tally = keys_of(), Tally()
        for batch in sliced(batches):
            found, counts = np.unique(keys(byte_texts(batch)), return_counts=True)
            tally.add(found, counts.astype(np.uint64))
            if tally.held > HELD:
                yield rows(tally)
                tally = Tally()
        yield rows(tally)

    return docs.select("text").mapInArrow(task, "part int, data binary")


def merged(parts: DataFrame, write: Callable[[int, np.ndarray, np.ndarray], dict], schema: str) -> DataFrame:
    """``write(part, keys, counts)`` for the whole counts of every part."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tally = None, Tally()
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != current:
                    if current is not None:
                        yield pa.RecordBatch.from_pylist([write(current, *tally.total())])
                    current, tally = part, Tally()
                tally.add(*unsqueeze(data))
        if current is not None:
            yield pa.RecordBatch.from_pylist([write(current, *tally.total())])

    return parts.repartition("part").sortWithinPartitions("part").mapInArrow(task, schema)


class Vocabulary:
    """The first level: numbers and counts of words."""

    def __init__(self, parts: list[tuple[int, str, int]], bits: int):
        self.bits, self.parts = bits, parts
        self.number = {part: k for k, (part, _, _) in enumerate(parts)}
        self.bases = np.concatenate([[0], np.cumsum([n for _, _, n in parts])]).astype(np.int64)
        self.size = int(self.bases[-1])
        self.files: dict[int, np.ndarray] = {}

    def _file(self, k: int) -> np.ndarray:
        if k not in self.files:
            self.files[k] = mapped(self.parts[k][1])
        return self.files[k]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of rising hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        part = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(hashes) else []
        for a, b in zip(edges[:-1], edges[1:]):
            k = self.number.get(int(part[a]))
            if k is not None:
                own = self._file(k)[:self.parts[k][2]]
                at = np.searchsorted(own, hashes[a:b])
                same = own[np.minimum(at, len(own) - 1)] == hashes[a:b]
                out[a:b][same] = self.bases[k] + at[same]
        return out

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Counts of words by number."""
        out = np.zeros(len(numbers), np.float64)
        part = np.searchsorted(self.bases, numbers, side="right") - 1
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(len(self.parts) + 1))
        for k in np.flatnonzero(np.diff(edges)):
            of = order[edges[k]:edges[k + 1]]
            n = self.parts[k][2]
            out[of] = self._file(k)[n:2 * n][numbers[of] - self.bases[k]]
        return out


class Level:
    """N-grams of one order above the vocabulary, in parts by key.

    A part is (first key, grams before it, grams, path of the keys and pointers, path of the counts, path of the codes).
    """

    def __init__(self, parts: list[tuple], vocabulary: int, split: dict[int, int], discount: float):
        self.parts, self.v, self.discount = parts, vocabulary, discount
        self.split = np.array(sorted(split), np.int64)
        self.split_next = np.array([split[c] for c in sorted(split)], np.float64)
        self.firsts = np.array([p[0] for p in parts], np.uint64)
        self.files: dict[int, tuple] = {}

    def _file(self, k: int) -> tuple[Sequence, Sequence, int]:
        if k not in self.files:
            words = mapped(self.parts[k][3])
            keys = Sequence(words[1:])
            self.files[k] = keys, Sequence(words[1 + keys.words:]), int(words[0])
        return self.files[k]

    def _by_part(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The stretches of rising keys that fall into each part."""
        edges = [*np.searchsorted(keys, self.firsts).tolist(), len(keys)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if b > a:
                yield k, slice(a, b)

    def keys(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return context.astype(np.uint64) * np.uint64(self.v) + word.astype(np.uint64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each gram (-1 if there is none) and its log10 probability, for rising keys."""
        number, log_p = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
        for k, of in self._by_part(keys):
            sequence, _, first = self._file(k)
            relative = keys[of] - np.uint64(first)
            relative = relative[:np.searchsorted(relative, np.uint64(sequence.universe))]
            at, same = sequence.search(relative)
            of, at = np.flatnonzero(same) + of.start, at[same]
            number[of] = self.parts[k][1] + at
            if self.parts[k][5] is not None and len(of):
                words = mapped(self.parts[k][5]) if (k, 5) not in self.files else self.files[k, 5]
                self.files[k, 5] = words
                log_p[of] = words[:256].view(np.float64)[words[256:].view(np.uint8)[at]]
        return number, log_p

    def continuations(self, context: np.ndarray) -> np.ndarray:
        """Different words seen after each of the rising contexts."""
        out = np.zeros(len(context), np.float64)
        for k, of in self._by_part(self.keys(context, np.zeros(len(context), np.int64))):
            _, pointers, first = self._file(k)
            at = context[of] - first // self.v
            here = (at >= 0) & (at + 1 < pointers.n)
            of, at = np.flatnonzero(here) + of.start, at[here]
            out[of] = (pointers.get(at + 1) - pointers.get(at)).astype(np.float64)
        if len(self.split):
            at = np.minimum(np.searchsorted(self.split, context), len(self.split) - 1)
            out = np.where(self.split[at] == context, self.split_next[at], out)
        return out

    def counts(self, number: np.ndarray) -> np.ndarray:
        """Counts of grams by number."""
        out, bases = np.zeros(len(number), np.float64), np.array([p[1] for p in self.parts], np.int64)
        part = np.searchsorted(bases, number, side="right") - 1
        for k in np.unique(part):
            of = np.flatnonzero(part == k)
            words = mapped(self.parts[k][4])
            out[of] = words[number[of] - bases[k]]
        return out

    def split_gram(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and last word of grams by number."""
        out, bases = np.zeros(len(number), np.uint64), np.array([p[1] for p in self.parts], np.int64)
        part = np.searchsorted(bases, number, side="right") - 1
        for k in np.unique(part):
            of = np.flatnonzero(part == k)
            sequence, _, first = self._file(int(k))
            out[of] = sequence.get(number[of] - bases[k]) + np.uint64(first)
        return (out // np.uint64(self.v)).astype(np.int64), (out % np.uint64(self.v)).astype(np.int64)

    def last_word(self, number: np.ndarray) -> np.ndarray:
        return self.split_gram(number)[1]


class Model:
    """All levels; made anew in every task from the table of files."""

    def __init__(self, vocabulary: tuple, levels: list[tuple], total: int):
        self.words, self.levels, self.total = Vocabulary(*vocabulary), [Level(*x) for x in levels], total

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / (self.total + ADDED * (self.words.size + 1))

    def numbered(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of each token."""
        found, at = np.unique(tokens, return_inverse=True)
        number = self.words.find(found)
        counts = np.zeros(len(found))
        counts[number >= 0] = self.words.counts(number[number >= 0])
        return number[at], counts[at]

    def contexts(self, number: np.ndarray, order: int) -> np.ndarray:
        """The context of each token for grams of an order: the place of the words before in the level below, -1 if unknown.

        Every text begins after the end of another, so the first context is the end; longer ones do not reach back
        beyond it: there the context is unknown.
        """
        end = self.words.find(np.array([END]))[0]
        context = np.concatenate([[end], number[:-1]])
        past_end = np.concatenate([[True], number[:-1] == end])
        for level in self.levels[:order - 2]:
            before = np.concatenate([[-1], context[:-1]])
            last = np.concatenate([[end], number[:-1]])
            context = np.where(past_end | (before < 0) | (last < 0), -1, self._grams(level, before, last)[0])
            past_end = past_end | np.concatenate([[True], past_end[:-1]])
        return context

    def _grams(self, level: Level, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number, log_p = np.full(len(word), -1, np.int64), np.zeros(len(word))
        known = np.flatnonzero((context >= 0) & (word >= 0))
        keys, at = np.unique(level.keys(context[known], word[known]), return_inverse=True)
        found, p = level.find(keys)
        number[known], log_p[known] = found[at], p[at]
        return number, log_p

    def context_counts(self, order: int, context: np.ndarray) -> np.ndarray:
        return self.words.counts(context) if order == 2 else self.levels[order - 3].counts(context)

    def backoff(self, order: int, context: np.ndarray) -> np.ndarray:
        """What is left for the lower order after each (known) context."""
        level = self.levels[order - 2]
        return level.discount * level.continuations(context) / self.context_counts(order, context)

    def log_probability(self, number: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token of texts that follow each other."""
        log_p = np.log10(self.base(counts))
        end = self.words.find(np.array([END]))[0]
        context, past_end = np.concatenate([[end], number[:-1]]), np.concatenate([[True], number[:-1] == end])
        for order, level in enumerate(self.levels, 2):
            gram, own = self._grams(level, context, number)
            missing = np.flatnonzero((gram < 0) & (context >= 0))
            different, at = np.unique(context[missing], return_inverse=True)
            left = self.backoff(order, different)
            lower = np.where(left > 0, np.log10(np.where(left > 0, left, 1)), 0.0)  # a context never followed by anything hands everything down
            log_p[missing] += lower[at]
            log_p[gram >= 0] = own[gram >= 0]
            context = np.where(past_end, -1, np.concatenate([[-1], gram[:-1]]))  # as in ``contexts``: the gram that ends a word before
            past_end = past_end | np.concatenate([[True], past_end[:-1]])
        return log_p

    def shortened(self, order: int, context: np.ndarray) -> np.ndarray:
        """The places of contexts of an order without their first word, one level below; all are grams of the training texts."""
        level = self.levels[order - 3]
        if order == 3:
            return level.last_word(context)
        before, last = level.split_gram(context)
        return self._grams(self.levels[order - 4], self.shortened(order - 1, before), last)[0]

    def lower(self, order: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Probability of a word after a context of an order, one word of it dropped."""
        if order == 2:
            return self.base(self.words.counts(word))
        different, at = np.unique(context, return_inverse=True)
        short = self.shortened(order, different)[at]
        gram, log_p = self._grams(self.levels[order - 3], short, word)
        p = 10 ** log_p
        missing = np.flatnonzero(gram < 0)
        different, at = np.unique(short[missing], return_inverse=True)
        p[missing] = self.backoff(order - 1, different)[at] * self.lower(order - 1, short[missing], word[missing])
        return p


FILES = "part long, path string, n long, total long"


def _vocabulary(train: DataFrame, folder: str, bits: int) -> DataFrame:
    def write(part: int, keys: np.ndarray, counts: np.ndarray) -> dict:
        stream, path = create(folder, f"words-{part:06d}", ".bin")
        stream.write(keys.tobytes())
        stream.write(counts.astype(np.uint64).tobytes())
        stream.close()
        return {"part": part, "path": path, "n": len(keys), "total": int(counts.sum())}

    cuts = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return landed(merged(counted(train, lambda: lambda texts: tokens_of(texts)[0], cuts), write, FILES), "words")


def _frequent(words: DataFrame, model: Callable[[], Model], least: int) -> dict[int, int]:
    """Numbers and counts of the words with more than ``least`` tokens; a fraction of the number of parts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model().words
        for batch in batches:
            for part, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                k = vocabulary.number[part]
                counts = vocabulary._file(k)[n:2 * n]
                of = np.flatnonzero(counts > least)
                yield pa.record_batch([pa.array(vocabulary.bases[k] + of), pa.array(counts[of].astype(np.int64))], names=["number", "count"])

    return {r["number"]: r["count"] for r in words.mapInArrow(task, "number long, count long").collect()}


def _frequent_grams(files: DataFrame, before: dict[int, int], least: int) -> dict[int, int]:
    """The same for the grams of a level, from the files of their counts; ``before`` has the grams before each part."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, path, n in zip(*(c.to_pylist() for c in batch.columns)):
                counts = mapped(path)[:n]
                of = np.flatnonzero(counts > least)
                yield pa.record_batch([pa.array(before[part] + of), pa.array(counts[of].astype(np.int64))], names=["number", "count"])

    return {r["number"]: r["count"] for r in files.select("part", "counts", "n").mapInArrow(task, "number long, count long").collect()}


def _level(train: DataFrame, model: Callable[[], Model], order: int, folder: str, cuts: np.ndarray, contexts: int, v: int) -> DataFrame:
    """Keys, pointers and counts of the grams of an order: ``part``, ``path``, ``counts``, ``n``, ``once``, ``twice``."""
    def keys_of():
        learnt = model()

        def keys(texts: list[bytes]) -> np.ndarray:
            number, _ = learnt.numbered(tokens_of(texts)[0])
            context = learnt.contexts(number, order)
            some = context >= 0
            return context[some].astype(np.uint64) * np.uint64(v) + number[some].astype(np.uint64)

        return keys

    starts = np.concatenate([np.zeros(1, np.uint64), cuts])
    ends = np.concatenate([cuts, np.array([contexts * v], np.uint64)])

    def write(part: int, keys: np.ndarray, counts: np.ndarray) -> dict:
        first = int(starts[part]) // v * v
        universe = -(-int(ends[part]) // v) * v - first
        relative = keys - np.uint64(first)
        pointers = np.searchsorted(relative, np.arange(universe // v + 1, dtype=np.uint64) * np.uint64(v)).astype(np.uint64)
        stream, path = create(folder, f"grams{order}-{part:06d}", ".ef")
        stream.write(np.array([first], np.uint64).tobytes())
        stream.write(build(relative, universe))
        stream.write(build(pointers, len(keys) + 1))
        stream.close()
        stream, held = create(folder, f"counts{order}-{part:06d}", ".bin")
        stream.write(counts.astype(np.uint64).tobytes())
        stream.close()
        return {"part": part, "path": path, "counts": held, "n": len(keys), "once": int((counts == 1).sum()), "twice": int((counts == 2).sum())}

    return landed(merged(counted(train, keys_of, cuts), write, "part long, path string, counts string, n long, once long, twice long"), "grams")


def _coded(files: DataFrame, model: Callable[[], Model], order: int, folder: str) -> DataFrame:
    """Quantised log probabilities of every gram of the top level: ``part`` and ``codes``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = model()
        level = learnt.levels[-1]
        for batch in batches:
            for part in batch.column(0).to_pylist():
                k = next(i for i, p in enumerate(level.parts) if p[6] == part)
                sequence, _, first = level._file(k)
                keys = sequence.get(np.arange(sequence.n)) + np.uint64(first)
                context, word = (keys // np.uint64(level.v)).astype(np.int64), (keys % np.uint64(level.v)).astype(np.int64)
                of = np.flatnonzero(np.diff(context, prepend=-1))
                each = np.diff(np.append(of, len(context)))
                before = learnt.context_counts(order, context[of])
                left = level.discount * level.continuations(context[of]) / before
                counts = mapped(level.parts[k][4])[:len(keys)].astype(np.float64)
                p = (counts - level.discount) / np.repeat(before, each) + np.repeat(left, each) * learnt.lower(order, context, word)
                log_p = np.log10(p)
                low = log_p.min()
                codes = ((log_p - low) * (255 / max(float(log_p.max() - low), 1e-9))).round().astype(np.uint8)  # bins of equal width bound the error
                sums, times = np.bincount(codes, log_p, 256), np.bincount(codes, minlength=256)
                stream, path = create(folder, f"codes{order}-{part:06d}", ".bin")
                stream.write((sums / np.maximum(times, 1)).tobytes())
                stream.write(codes.tobytes() + bytes(-len(codes) % 8))
                stream.close()
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([path])], names=["part", "codes"])

    return landed(files.select("part").repartition(max(1, files.count()), "part").mapInArrow(task, "part int, codes string"), "codes")


def learn(train: DataFrame, order: int = 2, parts: int | None = None) -> tuple[tuple, list[tuple], int]:
    """The files of a model of the ``text`` column: what ``Model`` is made of."""
    spark = train.sparkSession
    folder = shared(spark, "model")
    bits = max(3, ((parts or train.rdd.getNumPartitions()) - 1).bit_length())
    words = _vocabulary(train, folder, bits)
    found = sorted((r["part"], r["path"], r["n"], r["total"]) for r in words.collect())
    vocabulary, total = ([x[:3] for x in found], bits), sum(x[3] for x in found)
    v = sum(x[2] for x in found)
    levels: list[tuple] = []
    contexts = v
    for n in range(2, order + 1):
        if contexts == 0:
            break
        if contexts * v >= 1 << 63:
            raise ValueError("contexts times words exceed 63 bits")
        below = lambda kept=tuple(levels): Model(vocabulary, list(kept), total)
        wanted = min(1 << bits, contexts)
        cuts = {k * contexts // wanted * v for k in range(1, wanted)}
        split: dict[int, int] = {}
        least = total // (2 << bits)  # a frequent context has ranges of its own, by the word that follows
        frequent = _frequent(words, below, least) if n == 2 else _frequent_grams(files, {p[6]: p[1] for p in placed}, least)
        for context, count in frequent.items():
            pieces = min(v, -(-count * (1 << bits) // max(1, total)) + 1)
            split[context] = 0
            cuts |= {context * v + k * v // pieces for k in range(pieces)} | {(context + 1) * v}
        cuts = np.array(sorted(c for c in cuts if 0 < c < contexts * v), np.uint64)
        files = _level(train, below, n, folder, cuts, contexts, v)
        rows = sorted(files.collect(), key=lambda r: r["part"])
        once, twice = sum(r["once"] for r in rows), sum(r["twice"] for r in rows)
        discount = once / (once + 2 * twice) if once and twice else 0.5
        starts, before, placed = [0, *cuts.tolist()], 0, []
        for r in rows:
            first = starts[r["part"]]
            if first // v in split:
                split[first // v] += r["n"]
            placed.append((first, before, r["n"], r["path"], r["counts"], None, r["part"]))
            before += r["n"]
        level = (placed, v, split, discount)
        codes = {r["part"]: r["codes"] for r in _coded(files, lambda kept=(*levels, level): Model(vocabulary, list(kept), total), n, folder).collect()}
        levels.append(([(*p[:5], codes[p[6]], p[6]) for p in placed], v, split, discount))
        contexts = before
    return vocabulary, levels, total


def is_held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def score_texts(df: DataFrame, id: str = "doc_id", text: str = "text", order: int = 3, parts: int | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of each row.

    Learns from the rows whose crc32 of the id's decimal form is not divisible by 10.
    """
    docs = df.select(df[id].alias("doc_id"), is_held_out(df[id]).alias("held_out"), F.coalesce(df[text], F.lit("")).alias("text"))
    learnt = docs.sparkSession.sparkContext.broadcast(learn(docs.filter("not held_out"), order, parts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*learnt.value)
        for batch in sliced(batches):
            tokens, bounds = tokens_of(byte_texts(batch))
            number, counts = model.numbered(tokens)
            n = np.diff(bounds)
            sums = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has a token
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n), pa.array(sums((counts > 0).astype(np.int64))), pa.array(np.full(len(n), model.total, np.int64)),
                pa.array(sums(np.log10(model.base(counts)))), pa.array(sums(model.log_probability(number, counts)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(task, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
