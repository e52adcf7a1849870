"""Word shingles of many texts at once, as 64-bit hashes.

Words are runs of bytes other than space and 0x09-0x0D. Each byte stands for a fixed random
number; a word's hash is the polynomial of its bytes, read off prefix sums, so that a whole
slice of texts is hashed by a few array operations.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _RANDOM.integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the bounds of each text among them.

    Works in pieces of about a megabyte that end after a space, so the memory beside the result stays the same for any text.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[data]
    bounds = [0]
    while bounds[-1] < len(data):
        at = min(bounds[-1] + PIECE, len(data))
        bounds.append(at if at == len(data) else at + 1 + int(np.argmax(space[at:])))
    longest = max(np.diff(bounds))
    up, back = powers(_BASE, longest), powers(pow(_BASE, -1, 1 << 64), longest)
    places, hashes = [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        edge = np.flatnonzero(np.diff(space[a:b], prepend=True))  # starts and ends by turns; the last byte is a space
        starts, ends = edge[0::2], edge[1::2]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:b]] * up[:b - a], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * back[starts]))
        places.append(starts + a)
    firsts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), firsts)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The distinct shingles of each lower-cased text, sorted; fewer words than ``width`` make one shingle, no words none."""
    words, bounds = word_hashes([t.lower() for t in texts])
    n = max(0, len(words) - width + 1)
    rows = np.zeros(n, np.uint64)
    for k in range(width):
        rows += words[k:k + n] * _FACTOR[k]
    rows = mix(rows)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            out.append(np.unique(rows[a:b - width + 1]))
        elif b > a:
            short = (words[a:b] * _FACTOR[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64) * _FACTOR[width]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
