"""Words as exact identifiers, and recurring sequences of them by doubling, for whole Arrow batches.

Two words have one identifier if and only if their bytes are equal, and two sequences one rank if and
only if they have the same words: nothing here is decided by a hash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from citypulse.llm.words import SPACED, text_bytes


class Sequences(NamedTuple):
    """Words of consecutive documents; ``first`` has one entry per document and the total at its end."""

    words: pa.Array
    ids: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def joined(self, kept: np.ndarray) -> pa.Array:
        """The kept words of each document, joined by one space."""
        ends = np.concatenate([[0], np.cumsum(kept)])[self.first]
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), self.words.filter(pa.array(kept)))
        return pc.cast(pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())), pa.large_string())


def sequences(column: pa.Array) -> Sequences:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text; a null text has none."""
    data, at = text_bytes(column)
    inside = SPACED[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = at[:-1][at[:-1] < len(data)]
    begin[edge] = inside[edge]
    starts = np.flatnonzero(begin)
    first = np.searchsorted(starts, at)
    # Without the white space the words stand back to back.
    before = np.concatenate([[0], np.cumsum(inside)])
    bounds = np.concatenate([before[starts], before[-1:]]).astype(np.int64)
    own = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    ids = pc.dictionary_encode(own).indices.to_numpy().astype(np.int64)
    return Sequences(own, ids, first)


class Recurring(NamedTuple):
    """Positions whose sequence occurs more than once, ascending by sequence and then position, with dense ranks."""

    at: np.ndarray
    rank: np.ndarray

    def table(self, n: int) -> np.ndarray:
        """The rank of each of n positions; -1 where the sequence occurs once."""
        out = np.full(n, -1, np.int64)
        out[self.at] = self.rank
        return out


def recurring(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> Recurring:
    """Those of the ascending positions ``at`` whose pair of ranks (left, right) another one has, too."""
    if not len(at):
        return Recurring(at, at)
    key = left * (int(right.max()) + 1) + right
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    many = ~(new & np.concatenate([new[1:], [True]]))
    return Recurring(at[many], np.cumsum(new[many]) - 1)


def recurring_words(words: Sequences) -> Recurring:
    """Positions whose word occurs more than once in its document."""
    return recurring(np.arange(len(words.ids)), words.documents(), words.ids)


def doubled(part: Recurring, n: int, step: int) -> Recurring:
    """From sequences of some length m >= step to those of m + step: each is one at i and one at i + step.

    A sequence that occurs once has no longer one that recurs, so only recurring ones are looked at. As
    ranks differ between documents, what crosses the end of a document occurs once, and goes.
    """
    rank = part.table(n)
    at = np.sort(part.at)
    at = at[at + step < n]
    at = at[rank[at + step] >= 0]
    return recurring(at, rank[at], rank[at + step])
