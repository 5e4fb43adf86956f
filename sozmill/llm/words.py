"""Words of whole texts as numpy arrays: positions and 64-bit hashes.

A word is a run of digits, letters a-z (A-Z are lower-cased) and characters
outside ASCII. On UTF-8 bytes that is a table of 256 entries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_WORD = [chr(i).isascii() and chr(i).isalnum() or i >= 128 for i in range(256)]
#: Lower-cases A-Z and turns all that is no part of a word into a space.
LOWER = bytes(ord(chr(i).lower()) if i < 128 and w else i if w else 32 for i, w in enumerate(_WORD))
_IS_WORD = np.array(_WORD)
_LOWER = np.frombuffer(LOWER, dtype=np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {}


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some rows, in order. ``first`` has each row's first word, and the end."""

    data: np.ndarray  # lower-cased bytes of all rows
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One hash a word: a polynomial of its bytes, taken from running sums."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, n), out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * _powers_of(_INVERSE, n)[self.start])

    def text(self, row_start: int, row_end: int) -> str:
        """Words ``row_start`` to ``row_end`` of all rows, joined by spaces."""
        a, b = int(self.start[row_start]), int(self.end[row_end - 1])
        return b" ".join(self.data[a:b].tobytes().translate(LOWER).split()).decode()


def find_words(column: pa.Array) -> Words:
    """Words of each value of a binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.zeros(len(raw) + 1, dtype=bool)
    np.take(_IS_WORD, raw, out=inside[:-1])
    before = np.zeros(len(raw) + 1, dtype=bool)
    before[1:] = inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(raw)]
    start = inside & ~before
    start[rows] = inside[rows]
    end = before & ~inside
    end[rows] |= before[rows]
    start, end = np.flatnonzero(start), np.flatnonzero(end)
    return Words(_LOWER[raw], start, end, np.searchsorted(start, offsets))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive words from each word on; rows are not looked at."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(size), dtype=np.uint64)
    for i in range(size):
        out = out * _BASE + hashes[i:i + n]
    return mix(out)


def row_shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that lie inside one row: their hashes and their first words."""
    found = shingles(hashes, size)
    at = np.arange(len(found))
    row_end = np.repeat(words.first[1:], words.counts())[: len(found)]
    inside = at + size <= row_end
    return found[inside], at[inside]
