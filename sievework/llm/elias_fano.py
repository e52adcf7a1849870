"""Rising sequences of integers in Elias-Fano form, for lookups of many values at once.

Of each value the low bits are stored as they are; the high bits are unary gaps in a bit vector, with the number of
zeros before each of its 64-bit words beside it. All parts are plain arrays that can lie in a mapped file.
"""

from __future__ import annotations

import numpy as np

BLOCK_BITS = 64
_HEAD = 6


def low_width(n: int, universe: int) -> int:
    return max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers below 2**width side by side in 64-bit words, with a word to spare."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(width) > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def unpack(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.uint64)
    at = index.astype(np.int64) * width
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    value = words[word] >> shift
    over = shift > 0
    value[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
    return value & np.uint64((1 << width) - 1) if width < 64 else value


def build(values: np.ndarray, universe: int) -> bytes:
    """Rising ``values`` (uint64, below ``universe``) as bytes."""
    n, width = len(values), low_width(len(values), universe)
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    size = n + ((universe - 1) >> width if universe > 0 else 0) + 2
    bits = np.zeros(-(-size // BLOCK_BITS) * BLOCK_BITS, bool)
    bits[high] = True
    blocks = bits.reshape(-1, BLOCK_BITS)
    zeros = np.zeros(len(blocks) + 1, np.int64)
    np.cumsum(BLOCK_BITS - blocks.sum(axis=1), out=zeros[1:])
    low = pack(values & np.uint64((1 << width) - 1), width)
    packed = np.packbits(bits, bitorder="little").view(np.uint64)
    head = np.array([n, width, universe, len(low), len(packed), len(zeros)], np.uint64)
    return b"".join(x.tobytes() for x in (head, low, packed, zeros))


class Sequence:
    """A sequence in an array of 64-bit words."""

    def __init__(self, words: np.ndarray):
        n, width, universe, low, bits, zeros = (int(x) for x in words[:_HEAD])
        self.n, self.width, self.universe = n, width, universe
        self.low = words[_HEAD:_HEAD + low]
        self.bits = words[_HEAD + low:_HEAD + low + bits]
        self.zeros = words[_HEAD + low + bits:_HEAD + low + bits + zeros].view(np.int64)
        self.words = _HEAD + low + bits + zeros

    def _in_word(self, word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The place of the set bit of the given rank (from 0) in each word."""
        place = np.zeros(len(word), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.int64)
            right = rank >= count
            rank = np.where(right, rank - count, rank)
            place += np.where(right, half, 0)
            word = np.where(right, word >> np.uint64(half), word)
        return place

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Places of the ones or zeros of the given ranks (from 0)."""
        before = np.arange(len(self.zeros)) * BLOCK_BITS - self.zeros if ones else self.zeros
        word = np.searchsorted(before, rank, side="right") - 1
        bits = self.bits[word]
        return word * BLOCK_BITS + self._in_word(bits if ones else ~bits, rank - before[word])

    def get(self, index: np.ndarray) -> np.ndarray:
        """Values at the given indices."""
        if len(index) == 0:
            return np.zeros(0, np.uint64)
        high = (self._select(index, True) - index).astype(np.uint64)
        return high << np.uint64(self.width) | unpack(self.low, index, self.width)

    def search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the first element not less than each value (``n`` if there is none), and whether it is equal."""
        index, same = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        if self.n == 0 or len(values) == 0:
            return index, same
        high = (values >> np.uint64(self.width)).astype(np.int64)
        wanted = values & np.uint64((1 << self.width) - 1)
        later = high > 0
        index[later] = self._select(high[later] - 1, False) - high[later] + 1  # elements of lesser high parts
        last = self._select(high, False) - high  # and with those of the same
        low, top = index, last.copy()
        open_ = np.flatnonzero(low < top)
        while len(open_):  # by halves among those of the same high part
            middle = (low[open_] + top[open_]) >> 1
            less = unpack(self.low, middle, self.width) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            top[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < top[open_]]
        some = np.flatnonzero(index < last)
        same[some] = unpack(self.low, index[some], self.width) == wanted[some]
        return index, same
