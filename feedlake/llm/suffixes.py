"""Suffix arrays, common prefixes and an FM-index of one bounded shard, in numpy.

A shard is a list of strings over positive integers, laid one after another with a 0 after each.
All comparisons end at that 0: no two suffixes are taken as equal beyond it.
"""

from __future__ import annotations

import numpy as np


def lay_out(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One array of all strings (values from 1), each followed by 0, and where each begins."""
    at = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])]).astype(np.int64)
    text = np.zeros(at[-1], np.int64)
    for s, start in zip(strings, at, strict=False):
        text[start : start + len(s)] = s
    return text, at


def suffix_array(text: np.ndarray, at: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes in order, or ordered by their first ``depth`` values at least.

    Larsson-Sadakane refinement: a suffix's rank is the first place of its group; a round with
    step h orders every group of more than one suffix by the rank of what follows h further on,
    and so doubles the sorted depth. Groups of one are never looked at again. The first sort
    takes as many values as fit into 63 bits.
    """
    n = len(text)
    end = np.repeat(at[1:] - 1, np.diff(at))
    bits = max(1, int(text.max(initial=1)).bit_length())
    h = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for j in range(h):
        key <<= bits
        stop = max(0, n - j)
        here = text[j:]
        key[:stop] |= np.where(np.arange(stop) + j <= end[:stop], here, 0)
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    while n:
        group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[sa] = group
        alone = first & np.concatenate([first[1:], [True]])
        rest = np.flatnonzero(~alone)
        if not len(rest) or (depth is not None and h >= depth):
            break
        where = sa[rest]
        beyond = where + h
        inside = beyond <= end[where]
        second = np.where(inside, rank[np.minimum(beyond, n - 1)] + n, n - 1 - where)
        order = np.argsort(group[rest] * (2 * n) + second, kind="stable")
        sa[rest] = where[order]
        g, s = group[rest], second[order]
        split = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
        first[rest] |= split
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, at: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Per suffix, the values it shares with the suffix before it in the array, ``most`` at most.

    ``sa`` must be in full order. Kasai's walk: from one place of a string to the next the shared length falls by one at most.
    All strings are walked side by side; a step either lengthens the match of a string's place
    or settles that place and goes to the next.
    """
    n = len(text)
    shared = np.zeros(n, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place, stop = at[:-1].copy(), at[1:] - 1
    length = np.zeros(len(place), np.int64)
    live = np.flatnonzero(place < stop)
    place, stop, length = place[live], stop[live], length[live]
    while len(place):
        other = before[place]
        a = text[place + length]
        b = text[np.minimum(np.maximum(other, 0) + length, n - 1)]
        longer = (other >= 0) & (a == b) & (a > 0) & (length < most)
        settled = ~longer
        shared[place[settled]] = length[settled]
        length = np.where(longer, length + 1, np.maximum(length - 1, 0))
        place = place + settled
        keep = place < stop
        if not keep.all():
            place, stop, length = place[keep], stop[keep], length[keep]
    return shared


class WaveletTree:
    """A wavelet tree in matrix form: one bit vector a level, with counts every 64 bits."""

    def __init__(self, values: np.ndarray):
        n, top = len(values), int(values.max(initial=0))
        self.levels = []
        order = values
        for level in reversed(range(max(1, top.bit_length()))):
            bit = (order >> level) & 1
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = n - int(bit.sum())
            self.levels.append((level, packed, counts, zeros))
            order = np.concatenate([order[bit == 0], order[bit == 1]])

    def rank(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """A place that moves by one with each occurrence of ``value`` before ``i``."""
        for level, packed, counts, zeros in self.levels:
            word, within = i >> 6, (i & 63).astype(np.uint64)
            ones = counts[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << within) - np.uint64(1)))
            i = np.where((value >> level) & 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """Backward search over the strings of a shard."""

    def __init__(self, text: np.ndarray, at: np.ndarray, depth: int):
        sa = suffix_array(text, at, depth + 1)
        self.tree = WaveletTree(text[sa - 1])
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 2)
        self.counts, self.first = counts, np.concatenate([[0], np.cumsum(counts)])
        symbols = np.arange(len(counts))
        self.base = self.tree.rank(symbols, np.zeros(len(symbols), np.int64))

    def extend(self, value: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = self.first[value] - self.base[value]
        return shift + self.tree.rank(value, low), shift + self.tree.rank(value, high)

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
        """For each end, the length of the longest string ending before it that starts at two
        places of the shard or more; searched backwards, ``most`` values at most."""
        found = np.zeros(len(ends), np.int64)
        lane, place = np.arange(len(ends)), ends - 1
        value = text[place]
        low, high = self.first[value], self.first[value + 1]
        for length in range(1, most + 1):
            keep = (high - low >= 2) & (value > 0)
            lane, place, low, high = lane[keep], place[keep], low[keep], high[keep]
            found[lane] = length
            if length == most or not len(lane):
                break
            place = place - 1
            inside = place >= 0
            lane, place, low, high = lane[inside], place[inside], low[inside], high[inside]
            value = text[place]
            low, high = self.extend(value, low, high)
        return found
