"""Words of many texts at once, found and hashed on their UTF-8 bytes.

An Arrow string column is one byte buffer with offsets.  Separators are single
ASCII bytes, so words are found with a table look-up per byte.  A word's 64-bit
hash is the sum over its bytes of a number mixed from byte and position, so no
arrangement of two letters makes words agree by construction.  Texts are whole, in
slices of about ``SLICE`` bytes (a longer text is a slice of its own), which
bounds the memory of a task by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
BASE = 0x9E3779B97F4A7C15
BASE2 = 0xD6E8FEB86659FD93


def separator_table(kind: str) -> np.ndarray:
    """``space``: words are runs without 0x20 and 0x09-0x0D.  ``alnum``: words
    are runs of ASCII letters, digits and bytes from 0x80 up."""
    table = np.zeros(256, dtype=bool)
    if kind == "space":
        table[[0x20, *range(0x09, 0x0E)]] = True
    elif kind == "alnum":
        table[:0x80] = True
        for low, high in (("0", "9"), ("A", "Z"), ("a", "z")):
            table[ord(low) : ord(high) + 1] = False
    else:
        raise ValueError(kind)
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def byte_codes(lower: bool, seed: int = 7) -> np.ndarray:
    """A random odd number per byte; with ``lower`` A-Z get those of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed)) | np.uint64(1)
    if lower:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            grow = []
            for b in (self.base, self.inverse):
                x = np.full(size, b, dtype=np.uint64)
                x[0] = 1
                grow.append(np.multiply.accumulate(x))
            self.up, self.down = grow
        return self.up, self.down


@dataclass
class Words:
    """Words of the texts of a slice: byte range, hash, and per text the range
    of its words (``first`` has one entry more than there are texts)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()


class Tokeniser:
    def __init__(self, kind: str, lower: bool):
        self.separators = separator_table(kind)
        self.codes = byte_codes(lower)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """``offsets``: where each text starts in ``data``, and the end of the last."""
        n = len(data)
        inside = ~self.separators[data]
        edges = offsets[:-1][offsets[:-1] < n]
        before = np.empty(n, dtype=bool)
        before[1:], before[:1] = inside[:-1], False
        before[edges] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty(n, dtype=bool)
        after[:-1], after[-1:] = inside[1:], False
        after[edges[edges > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        size = ends - starts
        head = np.cumsum(size) - size
        hashes = size.astype(np.uint64) * np.uint64(BASE2)
        if len(starts):
            place = np.arange(head[-1] + size[-1]) - np.repeat(head, size)
            parts = mix(self.codes[data[inside]] + place.astype(np.uint64) * np.uint64(BASE))
            hashes = mix(hashes + np.add.reduceat(parts, head))
        return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def run_hashes(hashes: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Hash of each run of ``size`` neighbours, whatever text they are in."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers.upto(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[: n - size + 1])


def byte_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts."""
    data, offsets = byte_column(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
