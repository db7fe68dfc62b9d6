"""Words and their hashes for whole Arrow columns of text, computed on the UTF-8 bytes with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D.  These are ASCII, so splitting the bytes and
splitting the characters give the same words.  Hashes have 64 bits: a polynomial over random byte values modulo
2**64 with a final mix; results that depend on word identity hold unless two of the words in play collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once where a pass needs several machine words for each byte.
PIECE = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


class _Powers:
    """Powers of the base and of its inverse, extended when a longer piece comes along."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))
            self.down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE)]))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = 2 * PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows with at most ``limit`` bytes together; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the index of its first word (n + 1 values)."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = offsets[(offsets > 0) & (offsets < len(data))]
    first[rows] = inside[rows]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[rows - 1] = inside[rows - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each span; ``fold`` makes A-Z count as a-z."""
    values = _FOLDED if fold else _VALUES
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(int(np.searchsorted(ends, base + PIECE, "right")), at + 1)
        up, down = _powers(int(ends[stop - 1] - base) + 1)
        piece = values[data[base : ends[stop - 1]]]
        piece *= up[: len(piece)]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece, out=sums[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        hashes = (sums[e] - sums[s]) * down[s]
        out[at:stop] = mix64(hashes ^ ((e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        at = stop
    return out


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = mix64(out * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + n])
    return out
