"""Words and rolling hashes of whole Arrow text columns, in numpy.

A text is its UTF-8 bytes. Separators are ASCII, so words are found byte by byte without
decoding. A hash of bytes i..j is read from one running sum: with odd P,
H[i] = sum of (byte + 1) * P**i modulo 2**64, and (H[j] - H[i]) * P**-i depends on the bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 1 << 20

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)

_ascii = np.arange(256)
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: what each byte counts as; 0 separates.
FOLDED = np.where((_ascii >= 65) & (_ascii <= 90), _ascii + 32, _ascii).astype(np.uint8)
FOLDED_WORD = ((_ascii >= 48) & (_ascii <= 57)) | ((FOLDED >= 97) & (FOLDED <= 122)) | (_ascii >= 128)
#: Words of `[^\x20\x09-\x0D]+`, unchanged.
PLAIN = _ascii.astype(np.uint8)
PLAIN_WORD = ~((_ascii == 32) | ((_ascii >= 9) & (_ascii <= 13)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of each value over the whole word."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class _Powers:
    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, CHUNK) - 1, self.base & ((1 << 64) - 1), U64)
            self.table = np.concatenate([np.ones(1, U64), np.multiply.accumulate(steps)])
        return self.table[:n]


_powers, _inverses = _Powers(_P), _Powers(_P_INVERSE)


class Rolling:
    """Hashes of any range of a sequence of values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * _powers.upto(n), out=self.sums[1:])
        self.inverses = _inverses.upto(n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverses[start] + (end - start).astype(U64))

    def grams(self, k: int) -> np.ndarray:
        """Of each run of k values."""
        if len(self.sums) <= k:
            return np.zeros(0, U64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverses[: len(self.sums) - k])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each begins; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


@dataclass
class Chunk:
    """Texts first..last of a batch: their bytes, and where each text begins in them."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[Chunk]:
    data, at = text_bytes(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        last = min(last, len(column))
        yield Chunk(first, last, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


@dataclass
class Words:
    """The words of a chunk: first byte, byte after the last, hash, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    at: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def words(chunk: Chunk, becomes: np.ndarray = FOLDED, is_word: np.ndarray = FOLDED_WORD) -> Words:
    data, n = becomes[chunk.data], len(chunk.data)
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    borders = chunk.at[(chunk.at > 0) & (chunk.at < n)]
    begins[borders] |= inside[borders]
    stops[borders - 1] |= inside[borders - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(start, end, Rolling(data).of(start, end), np.searchsorted(start, chunk.at))


def gram_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and the first shingle of each text; a text of
    fewer words, but not none, is one shingle."""
    n = np.diff(w.at)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(at[-1]) - np.repeat(at[:-1] - w.at[:-1], count)
    last = np.minimum(first + k, np.repeat(w.at[1:], count))
    return Rolling(w.hash).of(first, last), at
