"""Words and shingles of whole texts as 64-bit codes, for many texts at a time in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased. Its code is a polynomial
over random byte values modulo 2**64, mixed: equal words have equal codes everywhere, and different
words share one with probability near 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_draw = np.random.default_rng(90210)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
INSIDE = np.ones(256, bool)
INSIDE[[0x20, 9, 10, 11, 12, 13]] = False
BYTE = (_draw.integers(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1))[LOWER]
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
#: Texts are joined until they reach this many bytes; a longer text goes alone.
CHUNK = 1 << 20
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= CHUNK:
            _powers[base] = have
    return have[:n]


class Words:
    """``code[i]`` of word i, bytes ``start[i]:end[i]`` of ``data``; text d has words ``off[d]:off[d + 1]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        n = len(data)
        self.data, self.bounds = data, bounds
        inside = INSIDE[data]
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
            before[bounds[:-1][bounds[:-1] < n]] = False
            after[bounds[1:][bounds[1:] > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.off = np.searchsorted(self.start, bounds)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[data] * powers(BASE, n), out=total[1:])
        self.code = mix((total[self.end] - total[self.start]) * powers(INVERSE, n + 1)[self.start])


def chunks(column: pa.Array):
    """``(first row, Words)`` over all rows of a string column; null counts as the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK, side="right")) - 1)
        yield row, Words(data[bounds[row]:bounds[stop]], bounds[row:stop + 1] - bounds[row])
        row = stop


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of ``k`` words, and where each text's codes begin.

    A text with fewer words has its whole sequence as the only code; one without words has none.
    """
    n, off = len(words.code), words.off
    padded = np.zeros(n + k, np.uint64)
    padded[:n] = words.code
    codes = np.zeros(n, np.uint64)
    for j in range(k):
        codes = codes * np.uint64(BASE) + padded[j:j + n]
    count = np.diff(off)
    last = np.repeat(off[1:], count)
    keep = np.arange(n) + k <= last
    for d in np.flatnonzero((count > 0) & (count < k)):
        a, b = off[d], off[d + 1]
        code = int(b - a)
        for x in words.code[a:b].tolist():
            code = (code * BASE + x) % 2**64
        codes[a], keep[a] = code, True
    have = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    return mix(codes[keep]), np.concatenate([[0], np.cumsum(have)])
