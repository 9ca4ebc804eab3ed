"""Whole-text scans of an Arrow string column with numpy, in bounded chunks.

A chunk is a run of whole texts of about ``CHUNK_BYTES``; a longer text is a
chunk of its own. Hashes are 64 bits wide and depend on the bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

#: Bytes outside words: space and \t \n \v \f \r.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_random = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
EXACT = _random | np.uint64(1)
LOWER = EXACT.copy()
LOWER[0x41:0x5B] = EXACT[0x61:0x7B]  # A-Z count as a-z

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    if len(_powers[base]) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """Texts ``first`` to ``last`` - 1 of a batch, as one byte array."""

    first: int
    last: int
    data: np.ndarray  # bytes
    bounds: np.ndarray  # where each text starts, and the end

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a flag or number per byte, for each text."""
        return np.diff(running(flags)[self.bounds])

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of True that stay within one text."""
        n = len(self.data)
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        after = np.concatenate((inside[1:], [False])) if n else inside
        starts = np.flatnonzero(inside & (~before | edge[:n]))
        ends = np.flatnonzero(inside & (~after | edge[1 : n + 1])) + 1
        return starts, ends

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.spans(~_SPACE[self.data])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = EXACT) -> np.ndarray:
        """Hash of each byte range; equal bytes and lengths give equal hashes."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.data] * _power(_BASE, n), out=sums[1:])
        ranges = (sums[ends] - sums[starts]) * _power(_BASE_INVERSE, n + 1)[starts]
        return mix(ranges + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def texts_of(self, starts: np.ndarray) -> np.ndarray:
        """Number of the text each position lies in."""
        return np.searchsorted(self.bounds, starts, "right") - 1

    def first_of(self, starts: np.ndarray) -> np.ndarray:
        """For each text, and the end: how many of the sorted positions come before it."""
        return np.searchsorted(starts, self.bounds, "left")


def running(x: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... numbers."""
    out = np.zeros(len(x) + 1, np.int64)
    np.cumsum(x, out=out[1:])
    return out


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    body = column.buffers()[2] if n else None
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield Chunk(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def windows(hashes: np.ndarray, text_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within one text, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(text_of[:n] == text_of[size - 1 :])
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + hashes[at + k])
    return out, at
