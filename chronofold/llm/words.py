"""Words of many texts at once, in numpy, from Arrow's own buffers: where each begins and ends, and a 64-bit hash of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at once.
SEGMENT = 1 << 20
#: Bytes of texts that are handled at once; a longer text stands alone.
BLOCK_BYTES = 2 << 20

_rng = np.random.default_rng(0x5EED)
_OF_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.cumprod(np.full(1 << 12, _BASE, np.uint64), dtype=np.uint64)


def table(separators: str) -> np.ndarray:
    """For each byte value, whether it is part of a word; separators: the characters (below 0x80) that are not."""
    out = np.ones(256, bool)
    out[np.frombuffer(separators.encode("latin-1"), np.uint8)] = False
    return out


#: Words between white space; words of letters, digits and all beyond ASCII (after lower-casing).
BLANKS = table(" \t\n\v\f\r")
MARKS = table("".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Texts in one byte array. Words w of text d: first[d] <= w < first[d + 1], bytes start[w]:end[w]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, part_of_word: np.ndarray, lower: bool):
        """bounds: where each text begins in data, the end of the last included."""
        self.raw = data
        self.data = LOWER[data] if lower else data
        inside = part_of_word[self.data]
        step = np.empty(inside.size + 1, bool)
        step[0], step[-1] = inside[:1].any(), inside[-1:].any()
        np.not_equal(inside[1:], inside[:-1], out=step[1:-1])
        edges = np.flatnonzero(step)
        inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < inside.size)]
        inner = np.unique(inner[inside[inner] & inside[inner - 1]])  # words of two texts that touch
        if inner.size:
            edges = np.sort(np.concatenate([edges, inner, inner]), kind="stable")
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, bounds)
        self.n, self.bounds = len(bounds) - 1, bounds

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(self.start.size, np.uint64)
        at = 0
        while at < self.start.size:
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + SEGMENT, "right")))
            start, size = self.start[at:to], self.end[at:to] - self.start[at:to]
            lo, hi = int(start[0]), int(self.end[to - 1])
            place = np.arange(lo, hi)
            offset = place - np.repeat(start, np.diff(np.append(start, hi)))  # also counts on through the gap behind a word
            if size.max() > _POWERS.size:
                powers = np.cumprod(np.full(int(offset.max()) + 1, _BASE, np.uint64), dtype=np.uint64)
            else:
                powers = _POWERS
                np.minimum(offset, _POWERS.size - 1, out=offset)
            value = _OF_BYTE[self.data[lo:hi]] * powers[offset]
            ends = np.empty(2 * (to - at), np.int64)
            ends[0::2], ends[1::2] = start - lo, self.end[at:to] - lo
            value = np.append(value, np.uint64(0))
            out[at:to] = np.add.reduceat(value, ends)[0::2] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            at = to
        return mix(out)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.n), self.counts)


def blocks(column: pa.Array, part_of_word: np.ndarray, lower: bool, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(from, to, words) of runs of rows; a null is an empty text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        bounds = offsets[at : to + 1]
        yield at, to, Block(data[bounds[0] : bounds[-1]], bounds - bounds[0], part_of_word, lower)
        at = to


def windows(hashes: np.ndarray, width: int, salt: int) -> np.ndarray:
    """A hash of each run of width words, at its first word (also across texts: the caller leaves those out)."""
    n = hashes.size - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = np.uint64((0xA24BAED4963EE407 + 2 * salt * 0x9FB21C651E98DF25) & (2**64 - 1) | 1)
    h = mix(hashes + np.uint64(salt * 0x632BE59BD9B4E019 & (2**64 - 1))) if salt else hashes
    out = h[:n].copy()
    for j in range(1, width):
        out *= base
        out += h[j : j + n]
    return mix(out)
