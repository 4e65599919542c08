"""Words of whole texts as 64-bit hashes, in numpy over Arrow buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 that
equals the runs of characters outside that ASCII white space.  All functions
work on a block of texts at once: one byte array, with the words numbered
through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)
_LONG = 64                      # longer words are hashed with blake2b


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix64: a bijection that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K3
    return h ^ (h >> np.uint64(31))


def text_blocks(column: pa.Array, block_bytes: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` for runs of rows with at most
    ``block_bytes`` of text (one row at least).  Null texts have no bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if (lengths != np.diff(offsets)).any():       # a null row may hold bytes
            column = column.fill_null("")
            yield from text_blocks(column, block_bytes)
            return
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, side="right")) - 1
        end = min(n, max(end, row + 1))
        lo, hi = offsets[row], offsets[end]
        yield row, end, data[lo:hi], offsets[row:end + 1] - lo
        row = end


class Words:
    """The words of a block of texts: ``start``/``end`` byte positions, ``doc``
    (row within the block), ``first`` (number of a row's first word; one entry
    more than rows) and ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        space = np.concatenate([SPACE[data], [True]])
        edge = np.zeros(len(data) + 1, dtype=bool)      # a new row begins here
        edge[offsets[:-1]] = True
        word = ~space
        begins = word & (np.concatenate([[True], space[:-1]]) | edge)
        self.start = np.flatnonzero(begins)
        ends = np.flatnonzero(word[:-1] & (space[1:] | edge[1:])) if len(data) else np.zeros(0, np.int64)
        self.end = ends + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.pos = np.arange(len(self.start)) - self.first[:-1][self.doc]
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        length = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        chunk = np.ndarray(len(self.data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
        h = length.astype(np.uint64) * _K1
        left = np.minimum(length, _LONG)
        at, idx = self.start, None
        while True:
            keep = np.minimum(left, 8).astype(np.uint64)
            x = chunk[at]
            x = np.where(keep >= 8, x, x & ((np.uint64(1) << (keep * np.uint64(8))) - np.uint64(1)))
            if idx is None:
                h = mix(h ^ x)
            else:
                h[idx] = mix(h[idx] * _K1 + x)
            more = np.flatnonzero(left > 8)
            if not len(more):
                break
            idx = more if idx is None else idx[more]
            at, left = at[more] + 8, left[more] - 8
        for i in np.flatnonzero(length > _LONG):
            digest = hashlib.blake2b(self.data[self.start[i]:self.end[i]], digest_size=8).digest()
            h[i] = np.frombuffer(digest, "<u8")[0]
        return h

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each word on, and whether they all lie
        in that word's text."""
        n = len(self.hash)
        h = np.zeros(max(0, n - k + 1), dtype=np.uint64)
        for j in range(k):
            h = mix(h * _K1 + self.hash[j:n - k + 1 + j])
        inside = self.pos[:len(h)] + k <= np.diff(self.first)[self.doc[:len(h)]]
        return h, inside
