import random
import re
from collections import defaultdict

import numpy as np
import pytest

from sievework.llm.licenses import PHRASES, TEMPLATES, Automaton, Scanner, notices, scan_licenses, whole_licences, words_of


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        sequences = [[rng.randint(0, 2) for _ in range(rng.randint(1, 8))] for _ in range(rng.randint(1, 5))]
        ends = defaultdict(set)
        for n, t in enumerate(sequences):
            for i in range(len(t)):
                for j in range(i + 1, len(t) + 1):
                    ends[tuple(t[i:j])].add((n, j))
        automaton, text = Automaton(sequences), [rng.randint(0, 3) for _ in range(25)]
        for i, (length, state) in enumerate(automaton.statistics(text)):
            assert length == max((k for k in range(1, i + 2) if tuple(text[i + 1 - k:i + 1]) in ends), default=0)
            if length:
                assert automaton.ends[state] == ends[tuple(text[i + 1 - length:i + 1])]


def base(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for p, label in PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_documents(odd, nothing):
    for r in scan_licenses(odd).collect():
        text = next(o["text"] for o in odd.collect() if o["doc_id"] == r["doc_id"]) if r["doc_id"] is not None else None
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert scan_licenses(odd).count() == odd.count() and scan_licenses(nothing).count() == 0


def test_templates_are_found_with_words_changed():
    scanner = Scanner()
    for label, template in TEMPLATES:
        text = f"A text before it. {template} And the text after of it."
        spans = scanner.scan([text.encode()])[0][5]
        assert any(s[0] == label and s[3] == 1 and words_of(text.encode())[s[1]:s[2]] == words_of(template.encode()) for s in spans)
    long = next(t for _, t in TEMPLATES if len(t.split()) > 15).split()
    changed = " ".join(long[:7] + ["SOMETHING"] + long[8:])
    assert 0.75 <= max(s[3] for s in scanner.scan([changed.encode()])[0][5]) < 1
    assert scanner.scan([b"the license of the software is in the public version", b""]) == [(10, 0, None, None, [], []), (0, 0, None, None, [], [])]
    assert scanner.scan([b"licensed under", b"cc by nc 4 0"])[0][5] == []  # no match runs on into the next text


def test_order_matters():
    text = "version 3 License Public General GNU the under licensed"
    assert Scanner().scan([text.encode()])[0][5] == []


@pytest.fixture(scope="module")
def scanner():
    return Scanner()


def labels(scanner, text):
    return sorted({s[0] for s in scanner.scan([text.encode()])[0][5]})


@pytest.mark.parametrize("text, label", [
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2"),
    ("it under the terms of the GNU General Public License as published by the SOMEBODY Free Software Foundation, either version 3 of the License, or (at your option)", "gpl-3"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "agpl-3"),
    ("GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "lgpl-2.1"),
    ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gpl-3"),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported License", "cc-by-sa-3.0"),
    ("https://creativecommons.org/licenses/by-nc-nd/2.5/", "cc-by-nc-nd-2.5"),
    ("Mozilla Public License Version 2.0", "mpl-2"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "apache-2"),
    ("// SPDX-License-Identifier: GPL-2.0-only", "gpl-2"),
])
def test_notices(scanner, text, label):
    assert labels(scanner, "before " + text + " behind") == [label]


def test_what_tells_a_licence_must_be_there(scanner):
    assert labels(scanner, "licensed under the GNU General Public License, as published by the Free Software Foundation") == []
    assert labels(scanner, "Creative Commons Attribution 7.0 and Mozilla Public License Version 9") == []


@pytest.mark.parametrize("label, text", whole_licences())
def test_whole_altered_and_cut_licences(scanner, label, text):
    text = text.replace("{", "").replace("}", "")
    words, rng = text.split(), random.Random(3)
    assert [s for s in scanner.scan([text.encode()])[0][5] if s[3] == 1] == [(label, 0, len(words_of(text.encode())), 1.0)] and labels(scanner, text) == [label]
    assert labels(scanner, " ".join(w if rng.random() > 0.04 else "ALTERED" for w in words)) == [label]
    assert labels(scanner, " ".join(w for w in words if rng.random() > 0.02)) == [label]
    half = labels(scanner, " ".join(words[:len(words) // 2 + 40]))
    assert label in half and (half == [label] or label.startswith("bsd"))


def test_what_two_licences_share_names_both(scanner):
    both = dict(whole_licences())
    two = both["bsd-2"]
    assert labels(scanner, two) == ["bsd-2"] and labels(scanner, both["bsd-3"]) == ["bsd-3"]
    assert labels(scanner, two[two.index("THIS SOFTWARE"):]) == ["bsd-2", "bsd-3"]
    assert labels(scanner, two + " and then " + both["mit"]) == ["bsd-2", "mit"]


def best_chain(scanner, anchors):
    """The most words a chain covers, over all subsets."""
    best = 0
    for mask in range(1, 1 << len(anchors)):
        chain = sorted((a for k, a in enumerate(anchors) if mask >> k & 1), key=lambda a: (a[1] + a[2], a[0] + a[2]))
        covered = chain[0][2]
        for (x, y, n), (inside, place, run) in zip(chain, chain[1:]):
            over = max(0, y + n - place, x + n - inside)
            if not (y + n < place + run and x + n < inside + run and over < run and place - y - n <= scanner.gap and inside - x - n <= scanner.skip):
                break
            covered += run - over
        else:
            best = max(best, covered)
    return best


def test_chains_equal_brute_force():
    small, rng = Scanner(gap=3, skip=6), random.Random(4)
    for _ in range(300):
        anchors = list({(rng.randint(0, 25), rng.randint(0, 25), rng.randint(2, 6)) for _ in range(rng.randint(1, 8))})
        chains = list(small.chains(anchors))
        assert max(c for _, c in chains) == best_chain(small, anchors)
        members = [a for chain, _ in chains for a in chain]
        assert len(members) == len(set(members)) <= len(anchors)


def test_only_runs_of_templates_are_streamed_and_none_is_lost():
    rng = random.Random(5)
    for _ in range(60):
        small = Scanner([(str(k), " ".join(rng.choice("abcd") for _ in range(rng.randint(4, 20)))) for k in range(4)], [], enough=10)
        words = np.array([small.number.get(rng.choice("abcdx").encode(), -1) for _ in range(80)])
        runs = [a for x, y in small.stretches(words) for a in small.anchors(words[x:y].tolist(), x)]
        assert sorted(runs) == sorted(small.anchors(words.tolist(), 0)) or set(runs) == set(small.anchors(words.tolist(), 0))
        for template, inside, place, run in runs:
            assert small.templates[template][inside:inside + run] == words[place:place + run].tolist()


def test_families_are_told_by_version():
    names = {label for label, _ in notices()}
    assert {"cc-by-nc-sa-4.0", "cc-by-1.0", "agpl-3", "lgpl-2"} <= names
