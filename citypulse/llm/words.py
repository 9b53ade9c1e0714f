"""Words and their hashes for whole Arrow batches, without a Python loop over words or documents.

A word is a longest run of word bytes of the UTF-8 text. ``SPACED`` splits at the six ASCII white
spaces; ``ALNUM`` keeps digits, letters and every character beyond ASCII. Hashes are 64 bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that are looked at together; a longer document is looked at alone.
SLICE_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix((np.arange(256, dtype=U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
_STEP = U64(0xD1342543DE82EF95 ^ 6)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


class Words(NamedTuple):
    """Words of consecutive documents. ``first`` has one entry per document and the total at its end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, i: int, j: int) -> bytes:
        """Words i to j, joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j], strict=True))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and where each row begins; a null row has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    i, n = 0, len(size)
    while i < n:
        before = end[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(end, before + limit, side="right")))
        yield i, j
        i = j


def words(column: pa.Array, kind: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, at = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = kind[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = at[:-1][at[:-1] < len(data)]
    begin[edge] = inside[edge]
    edge = at[1:][at[1:] > 0] - 1
    end[edge] = inside[edge]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, at)
    return Words(data, starts, ends, _hashes(data, starts, ends), first)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, U64)
    size = ends - starts
    own = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(own, size)
    powers = np.multiply.accumulate(np.full(int(size.max()), _STEP))
    value = _BYTE[data[place + np.repeat(starts, size)]]
    value *= powers[place]
    return mix(np.add.reduceat(value, own) + size.astype(U64))


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts."""
    return mix(a * U64(0x9E3779B97F4A7C15) + b)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; positions without k words are left out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    part, size, out, have = hashes, 1, None, 0
    while True:
        if k & size:
            piece = part[have : have + n]
            out = piece if out is None else join(out, piece)
            have += size
        if have == k:
            return out
        part = join(part[:-size], part[size:])
        size *= 2


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Positions from which k words of one document follow."""
    counts = np.diff(first)
    fits = np.maximum(counts - k + 1, 0)
    own = np.cumsum(fits) - fits
    return np.arange(int(fits.sum())) + np.repeat(first[:-1] - own, fits)
