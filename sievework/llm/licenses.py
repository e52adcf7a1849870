"""Licence texts found with a suffix automaton.

The words of all licence templates, whole licences and the notices by which works state them, make one generalised suffix
automaton. A text is streamed through it, which gives at every word the longest run of template words that ends there (its
matching statistics). Where a run cannot be lengthened, it and its ends that other templates share are anchors if they have at
least ``least`` words or are a whole template. Per template, the chain of anchors in the same order in text and template that
covers most words is found by dynamic programming; between two of its anchors lie at most ``gap`` words of the text and ``skip`` of the template.

A chain is a span of its licence if it covers enough of the template, or at least ``enough`` words as an excerpt, and holds the
words that tell the template from its like (in braces). Of spans of different licences in the same place the
one that covers more words stays, among equals the one that covers more of its template; excerpts that
several licences have in common name all of them.

Only words that lie in a run of template words as short as an anchor are streamed; runs are looked up by their hashes first.

Defined results: a null text is empty and has no words, no places, no labels and a score of 0; rows that repeat an id
are judged each; an empty table gives an empty result. Other columns are not read. A very long text is held whole by one task, with
its words and anchors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_texts, documents_of, sliced

#: Phrases looked up as they are, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Names of Creative Commons licences, and identifiers of licences in short tags.
COMMONS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
TAGS = {
    "mit": "MIT", "apache-2": "Apache-2.0", "bsd-2": "BSD-2-Clause", "bsd-3": "BSD-3-Clause", "isc": "ISC", "unlicense": "Unlicense", "cc0": "CC0-1.0",
    "mpl-1.1": "MPL-1.1", "mpl-2": "MPL-2.0", "gpl-2": "GPL-2.0", "gpl-3": "GPL-3.0", "lgpl-2.1": "LGPL-2.1", "lgpl-3": "LGPL-3.0", "agpl-3": "AGPL-3.0",
}

#: Wordings by which works name or state public licences; what is in braces tells one from its like.
NOTICES = (
    ("mit", "released under the {MIT} License"),
    ("mit", "licensed under the {MIT} License"),
    ("apache-2", "Licensed under the Apache License, {Version 2.0}"),
    ("apache-2", "{Apache} License {Version 2.0}"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd-2", "licensed under the BSD {2-Clause} License"),
    ("bsd-3", "licensed under the BSD {3-Clause} License"),
    ("mpl-1.1", "{Mozilla} Public License {Version 1.1}"),
    ("mpl-2", "{Mozilla} Public License {Version 2.0}"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, {v. 2.0}"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "licensed under {CC0} 1.0 Universal"),
    ("cc0", "Creative Commons {CC0} 1.0 Universal"),
)
#: The GNU licences, their names and versions.
GNU = (
    ("gpl-1", "General", "1"),
    ("gpl-2", "General", "2"),
    ("gpl-3", "General", "3"),
    ("lgpl-2", "Library General", "2"),
    ("lgpl-2.1", "Lesser General", "2.1"),
    ("lgpl-3", "Lesser General", "3"),
    ("agpl-3", "Affero General", "3"),
)


def notices() -> list[tuple[str, str]]:
    """All notices, those of families by name and version."""
    out = list(NOTICES)
    for label, name, version in GNU:
        out += [(label, f"{{GNU {name}}} Public License {{version {version}}}"), (label, f"{{GNU {name}}} Public License {{v{version}}}"),
                (label, f"under the terms of the {{GNU {name}}} Public License as published by the Free Software Foundation, either {{version {version}}} of the License"),
                (label, f"under the terms of the {{GNU {name}}} Public License {{version {version}}} as published by the Free Software Foundation")]
    for code, name in COMMONS.items():
        for version in COMMONS_VERSIONS:
            out += [(f"cc-{code}-{version}", f"licensed under {{CC {code} {version}}}"), (f"cc-{code}-{version}", f"Creative Commons {{{name} {version}}}"),
                    (f"cc-{code}-{version}", f"{{creativecommons.org/licenses/{code}/{version}}}")]
    return out + [(label, f"{{SPDX-License-Identifier: {tag}}}") for label, tag in TAGS.items()]


def whole_licences() -> list[tuple[str, str]]:
    """The licence texts beside this module, each named by its label."""
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licences").glob("*.txt"))]


#: Label and text of each template.
TEMPLATES = (*whole_licences(), *notices())

_SPLIT = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of digits, letters and characters beyond ASCII, A-Z in lower case."""
    return text.translate(_SPLIT).split()


class Automaton:
    """Generalised suffix automaton of sequences of numbers.

    A state stands for the runs that end at the same places; ``ends`` of a state are the templates
    and the positions behind the run there, kept for states of ``least`` words or more.
    """

    def __init__(self, sequences: Sequence[Sequence[int]], least: int = 1):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.own = [-1], [0], [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for position, word in enumerate(sequence, 1):
                last = self._extend(last, word)
                self.own[last].append((number, position))
        self.ends: list[set] = [set(o) if n >= least else set() for o, n in zip(self.own, self.length)]
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.length[self.link[state]] >= least:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, next: dict[int, int], link: int) -> int:
        self.next.append(next)
        self.link.append(link)
        self.length.append(length)
        self.own.append([])
        return len(self.next) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """The part of ``to`` that holds runs no longer than one word after ``state``."""
        if self.length[to] == self.length[state] + 1:
            return to
        part = self._state(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = part
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, state = self._state(self.length[last] + 1, {}, 0), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def statistics(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """At every word the length of the longest run that ends there, and its state."""
        state = matched = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            yield matched, state


class Scanner:
    """Finds phrases and licence spans in the words of texts."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
                 least: int = 4, cover: float = 0.75, gap: int = 8, skip: int = 64, enough: int = 60):
        self.number: dict[bytes, int] = {}
        self.labels = [label for label, _ in templates]
        self.templates, self.telling = [], []
        for _, text in templates:
            words, telling = [], set()
            for k, part in enumerate(re.split("[{}]", text)):
                new = [self._of(w) for w in words_of(part.encode())]
                telling |= set(range(len(words), len(words) + len(new))) if k % 2 else set()
                words += new
            self.templates.append(words)
            self.telling.append(telling)
        self.phrases = [([self._of(w) for w in words_of(p.encode())], label) for p, label in phrases]
        self.least, self.cover, self.gap, self.skip, self.enough = least, cover, gap, skip, enough
        self.shortest = min([least, *map(len, self.templates)])
        # a notice may lie within a whole licence, whose runs would hide where the notice's end: each kind has its own automaton
        kinds = [[k for k, t in enumerate(self.templates) if (len(t) < enough) == short] for short in (False, True)]
        self.automata = [(Automaton([self.templates[k] for k in kind], self.shortest), kind) for kind in kinds if kind]
        self.known = np.unique(np.concatenate([self._runs(np.array(t, np.int64)) for t in self.templates]))

    def _of(self, word: bytes) -> int:
        return self.number.setdefault(word, len(self.number))

    def _runs(self, ids: np.ndarray) -> np.ndarray:
        """A hash of the ``shortest`` words from each word on."""
        n = max(0, len(ids) - self.shortest + 1)
        out = np.zeros(n, np.uint64)
        for k in range(self.shortest):
            out = (out + ids[k:k + n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """First word and word behind the last of all parts of ``ids`` that may hold runs of templates."""
        runs = self._runs(ids)
        at = np.minimum(np.searchsorted(self.known, runs), len(self.known) - 1)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], self.known[at] == runs, [False]])))
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            yield a, b + self.shortest - 1

    def anchors(self, words: Sequence[int], start: int) -> list[tuple[int, int, int, int]]:
        """Runs that cannot be lengthened: template, place in the template, place in the text, length."""
        found = []
        for automaton, kind in self.automata:
            before = (0, 0)
            for place, (matched, state) in enumerate([*automaton.statistics(words), (0, 0)], start):
                run, at = before
                if run and matched != run + 1:
                    longer: set = set()
                    while run >= self.shortest:
                        for number, position in automaton.ends[at] - longer:
                            if run >= min(self.least, len(self.templates[kind[number]])):
                                found.append((kind[number], position - run, place - run, run))
                        longer, at = automaton.ends[at], automaton.link[at]
                        run = automaton.length[at]
                before = (matched, state)
        return found

    def chains(self, anchors: list[tuple[int, int, int]]) -> Iterator[tuple[list[tuple[int, int, int]], int]]:
        """Of one template's anchors (place in the template, in the text, length) the chains that cover most, and how many words each covers.

        Anchors of a chain may overlap; words are counted once.
        """
        anchors = sorted(anchors, key=lambda a: (a[1] + a[2], a[0] + a[2]))
        best, before = [], []
        for i, (inside, place, run) in enumerate(anchors):
            most, chosen, j = run, -1, i - 1
            while j >= 0 and anchors[j][1] + anchors[j][2] >= place - self.gap:
                x, y, n = anchors[j]
                over = max(0, y + n - place, x + n - inside)
                if y + n < place + run and x + n < inside + run and inside - x - n <= self.skip and over < run and best[j] + run - over > most:
                    most, chosen = best[j] + run - over, j
                j -= 1
            best.append(most)
            before.append(chosen)
        used = [False] * len(anchors)
        for i in sorted(range(len(anchors)), key=lambda i: (-best[i], i)):
            chain, at = [], i
            while at >= 0 and not used[at]:
                chain.append(anchors[at])
                used[at] = True
                at = before[at]
            if chain and at < 0:
                yield chain[::-1], best[i]

    def spans(self, anchors: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Label, first word, word behind the last and covered share of each chain that covers enough and is told from its like."""
        by_template: dict[int, list] = {}
        for template, *anchor in anchors:
            by_template.setdefault(template, []).append(tuple(anchor))
        found = []
        for template, own in by_template.items():
            for chain, covered in self.chains(own):
                share, first, end = covered / len(self.templates[template]), chain[0][1], chain[-1][1] + chain[-1][2]
                whole = share >= self.cover and self.telling[template] <= {k for x, _, n in chain for k in range(x, x + n)}
                if whole or covered >= max(self.enough, self.cover * (end - first)):
                    found.append((covered, whole, share, self.labels[template], first, end))
        if not found:
            return []
        found.sort(key=lambda f: (-f[0], not f[1], -f[2], f[4], f[3]))
        low = min(f[4] for f in found)
        owner = np.full(max(f[5] for f in found) - low, -1, np.int64)
        out = []
        for k, (covered, whole, share, label, first, end) in enumerate(found):
            part = owner[first - low:end - low]
            others, times = np.unique(part[part >= 0], return_counts=True)
            stronger = [(found[o], n) for o, n in zip(others.tolist(), times.tolist()) if found[o][3] != label]
            if any(found[o][1] and found[o][3] == label and found[o][4] <= first and end <= found[o][5] for o in others.tolist()):
                continue  # a notice within its licence
            # an excerpt of equal size that is no whole licence either is common to both
            if 2 * sum(n for _, n in stronger) <= end - first or not whole and all(o[0] == covered and not o[1] for o, _ in stronger):
                part[part < 0] = k
                out.append((label, first, end, share))
        return sorted(out, key=lambda s: (s[1], s[2], s[0]))

    def scan(self, texts: list[bytes]) -> list[tuple]:
        """Of each text: words, base places, first and last of them, base labels, spans."""
        split = [words_of(t) for t in texts]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(w) + 1 for w in split], out=bounds[1:])  # a stop after each text
        get = self.number.get
        ids = np.full(int(bounds[-1]), -1, np.int64)
        for a, words in zip(bounds, split):
            ids[a:a + len(words)] = [get(w, -1) for w in words]
        places, labels = [], []
        for phrase, label in self.phrases:
            hit = ids[:len(ids) - len(phrase) + 1] == phrase[0]
            for k, word in enumerate(phrase[1:], 1):
                hit &= ids[k:len(ids) - len(phrase) + 1 + k] == word
            at = np.flatnonzero(hit)
            places.append(at)
            labels += [label] * len(at)
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        base: dict[int, list] = {}
        for place, label in zip(at.tolist(), labels):
            text = int(np.searchsorted(bounds, place, side="right")) - 1
            base.setdefault(text, []).append((place - int(bounds[text]), label))
        anchors: dict[int, list] = {}
        for a, b in self.stretches(ids):
            text = int(np.searchsorted(bounds, a, side="right")) - 1
            found = self.anchors(ids[a:b].tolist(), a - int(bounds[text]))
            if found:
                anchors.setdefault(text, []).extend(found)
        out = []
        for k, words in enumerate(split):
            known = base.get(k, [])
            firsts = [p for p, _ in known]
            out.append((len(words), len(known), min(firsts, default=None), max(firsts, default=None), sorted({x for _, x in known}), self.spans(anchors.get(k, []))))
        return out


@lru_cache(maxsize=2)
def scanner(options: tuple) -> Scanner:
    """One scanner a worker."""
    return Scanner(**dict(options))


SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("covered", pa.float64())])


def scan_licenses(df: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` and the ``spans`` of each row.

    ``options`` are those of ``Scanner``. The score is the largest covered share of a span.
    """
    docs = documents_of(df, id, text)
    given = tuple(sorted({"templates": TEMPLATES, **{k: tuple(map(tuple, v)) if k in ("templates", "phrases") else v for k, v in options.items()}}.items()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(given).scan
        for batch in sliced(batches):
            n, base, first, last, own, spans = zip(*scan(byte_texts(batch)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *[pa.array(c, pa.int64()) for c in (n, base, first, last)], pa.array([",".join(o) for o in own]),
                pa.array([",".join(sorted({*o, *(x[0] for x in s)})) for o, s in zip(own, spans)]), pa.array([max((x[3] for x in s), default=0.0) for s in spans]),
                pa.array([[dict(zip(SPAN.names, x)) for x in s] for s in spans], pa.list_(SPAN))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.mapInArrow(task, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
                                 "base_labels string, labels string, score double, "
                                 "spans array<struct<label: string, first_word: long, end_word: long, covered: double>>")
