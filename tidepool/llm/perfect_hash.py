"""Minimal perfect hashes over word lists, sharded, with the words stored.

A shard holds about ``SHARD_WORDS`` words.  Level by level its words fall into
a table of twice their number; a word alone in its place stays there, the
others go on to the next level.  The places taken, counted through, number the
words without gaps.  Words that no level can part (equal 64-bit hashes) come
after them in a plain list.

Tables are built per shard inside Spark tasks.  ``Lexicon`` joins some shards
for lookups: the place found is compared byte by byte with the word stored
there, so an unknown word is never taken for a known one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_join
from .words import Words, mix, text_blocks

SHARD_WORDS = 1 << 16
LEVELS = 16
SPREAD = 2                       # places per word of a level's table

BUILT = ("lang string, shard int, shards int, n int, sizes array<int>, bits binary, keys binary, lengths binary")


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every byte on, as whole numbers."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))


def same_bytes(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``length`` bytes from ``at`` in ``a`` and from ``bt`` in ``b``
    (both as ``eights``) are the same, for many places at once."""
    same = np.ones(len(at), dtype=bool)
    idx = np.flatnonzero(length > 0)
    at, bt, left = at[idx], bt[idx], length[idx]
    while len(idx):
        diff = a[at] ^ b[bt]
        part = left < 8
        diff[part] &= (np.uint64(1) << (left[part].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        same[idx[diff != 0]] = False
        more = np.flatnonzero((left > 8) & (diff == 0))
        idx, at, bt, left = idx[more], at[more] + 8, bt[more] + 8, left[more] - 8
    return same


def numbered(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of a block, equal for equal words, and the place
    of a first word per number.  Compares bytes, not hashes alone."""
    _, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
    length = words.end - words.start
    rep = first[number]
    wrong = length != length[rep]
    ok = np.flatnonzero(~wrong)
    data = eights(words.data)
    wrong[ok] = ~same_bytes(data, words.start[ok], data, words.start[rep[ok]], length[ok])
    if wrong.any():                                    # different words of one hash
        seen: dict[bytes, int] = {}
        more = []
        for i in np.flatnonzero(wrong):
            word = words.data[words.start[i]:words.end[i]].tobytes()
            if word not in seen:
                seen[word] = len(first) + len(more)
                more.append(i)
            number[i] = seen[word]
        first = np.concatenate([first, np.array(more, dtype=first.dtype)])
    return number, first


def strings(words: Words, at: np.ndarray) -> pa.Array:
    """The words numbered ``at`` as an Arrow column."""
    length = words.end[at] - words.start[at]
    offsets = np.concatenate([[0], np.cumsum(length)])
    take = np.repeat(words.start[at] - offsets[:-1], length) + np.arange(offsets[-1])
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(words.data[take].tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(at), buffers).cast(pa.string())


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _place(hashes: np.ndarray, level: int, size) -> np.ndarray:
    h = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
    return (((h & np.uint64(0xFFFFFFFF)) * np.asarray(size).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def build_tables(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """``(size of each level, places taken, order of the words)``."""
    sizes, taken, order = [], [], []
    left = np.arange(len(hashes))
    for level in range(LEVELS):
        size = -(-SPREAD * len(left) // 64) * 64       # whole 64-bit words
        sizes.append(size)
        if not size:
            continue
        at = _place(hashes[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        taken.append(alone)
        stay = alone[at]
        order.append(left[stay][np.argsort(at[stay])])
        left = left[~stay]
    order.append(left)
    bits = np.concatenate(taken) if taken else np.zeros(0, bool)
    return sizes, np.packbits(bits, bitorder="little"), np.concatenate(order).astype(np.int64)


def _hash_column(column: pa.Array) -> list[Words]:
    return [Words(data, offsets) for _, _, data, offsets in text_blocks(column)]


def shard_row(lang: str, shard: int, shards: int, column: pa.Array) -> dict:
    """The line of one shard's distinct words."""
    sizes, bits, order = build_tables(np.concatenate([p.hash for p in _hash_column(column)]))
    column = column.take(pa.array(order)).cast(pa.large_string())
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64)[:len(column) + 1])
    keys = column.buffers()[2].to_pybytes()[:int(lengths.sum())]
    return {"lang": lang, "shard": shard, "shards": shards, "n": len(column), "sizes": sizes, "bits": bits.tobytes(),
            "keys": keys, "lengths": lengths.astype(np.int32).tobytes()}


def build(words: DataFrame, name: str) -> DataFrame:
    """A table with a line per shard of the distinct ``(lang, word)`` of
    ``words``; words are not empty and hold no white space.  Every lang has
    shards of its own, and ``base`` is the first number of a shard's words."""
    shards = max(1, -(-words.count() // SHARD_WORDS))

    def place(batches):
        for batch in batches:
            parts = _hash_column(batch["word"])
            shard = np.concatenate([_shard(p.hash, shards) for p in parts]) if parts else np.zeros(0, np.int64)
            yield pa.record_batch([batch["lang"], batch["word"], pa.array(shard.astype(np.int32))],
                                  names=["lang", "word", "shard"])

    def tables(key, group):
        row = shard_row(key[0].as_py(), key[1].as_py(), shards, group["word"].combine_chunks())
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())] + [pa.binary()] * 3
        return pa.table([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

    built = materialize(words.select("lang", "word").mapInArrow(place, "lang string, word string, shard int")
                        .groupBy("lang", "shard").applyInArrow(tables, BUILT), f"{name}-tables")
    base = built.select("lang", "shard", (F.sum("n").over(Window.partitionBy("lang").orderBy("shard")) - F.col("n")).alias("base"))
    return materialize(small_join(built, materialize(base, f"{name}-bases"), ["lang", "shard"]), f"{name}-lexicon")


def stored_bytes(n, bits, keys):
    """Bytes that a loaded shard takes, about."""
    return F.octet_length(bits) * F.lit(2) + F.octet_length(keys) + F.lit(8) * n


class Lexicon:
    """Lookup over some shards of one lang, from the rows of ``build``."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.shards = rows[0]["shards"]
        self.stored = None
        self.size = np.zeros((self.shards, LEVELS), dtype=np.int64)
        self.start = np.zeros((self.shards, LEVELS), dtype=np.int64)
        bits, lengths, keys, number, self.rest = [], [], [], [], {}
        shift = np.zeros(self.shards, dtype=np.int64)       # rank -> place among the stored words
        at = rank = stored = 0
        for r in rows:
            s, sizes = r["shard"], np.array(r["sizes"], dtype=np.int64)
            self.size[s] = sizes
            self.start[s] = at + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            at += int(sizes.sum())
            part = np.frombuffer(r["bits"], dtype=np.uint8)
            bits.append(part)
            shift[s] = stored - rank
            placed = int(np.bitwise_count(part).sum())
            length = np.frombuffer(r["lengths"], dtype=np.int32)
            lengths.append(length)
            keys.append(np.frombuffer(r["keys"], dtype=np.uint8))
            number.append(r["base"] + np.arange(len(length)))
            ends = np.cumsum(length)
            for i in range(placed, len(length)):             # words of one hash
                word = bytes(r["keys"][ends[i] - length[i]:ends[i]])
                self.rest[word] = r["base"] + i
            rank, stored = rank + placed, stored + len(length)
        self.bits = np.concatenate(bits + [np.zeros(8, np.uint8)]).view("<u8") if at else np.zeros(1, "<u8")
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits).astype(np.int64))]).astype(np.uint32)
        self.shift = shift
        self.number = np.concatenate(number)
        self.length = np.concatenate(lengths)
        self.keys = np.concatenate(keys)
        self.key_at = np.concatenate([[0], np.cumsum(self.length.astype(np.int64))])[:-1]

    def lookup(self, words: Words) -> np.ndarray:
        """The number of each word of a block; -1: not a word of this lexicon."""
        out = np.full(len(words.hash), -1, dtype=np.int64)
        shard = _shard(words.hash, self.shards)
        idx = np.flatnonzero(self.size[shard, 0] > 0)
        found, place = [], []
        for level in range(LEVELS):
            if not len(idx):
                break
            s = shard[idx]
            at = self.start[s, level] + _place(words.hash[idx], level, self.size[s, level])
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            cell = self.bits[at >> 6]
            hit = (cell & bit) != 0
            rank = self.rank[at[hit] >> 6] + np.bitwise_count(cell[hit] & (bit[hit] - np.uint64(1)))
            found.append(idx[hit])
            place.append(rank.astype(np.int64) + self.shift[s[hit]])
            idx = idx[~hit]
            if level + 1 < LEVELS:
                idx = idx[self.size[shard[idx], level + 1] > 0]
        if found:
            at, slot = np.concatenate(found), np.concatenate(place)
            length = words.end[at] - words.start[at]
            like = length == self.length[slot]
            at, slot, length = at[like], slot[like], length[like]
            if self.stored is None:                    # once per worker, not in what is broadcast
                self.stored = eights(self.keys)
            ok = same_bytes(eights(words.data), words.start[at], self.stored, self.key_at[slot], length)
            out[at[ok]] = self.number[slot[ok]]
        if self.rest:
            longest = max(map(len, self.rest))
            for i in np.flatnonzero((out < 0) & (words.end - words.start <= longest)):
                out[i] = self.rest.get(words.data[words.start[i]:words.end[i]].tobytes(), -1)
        return out


def load(rows: list) -> dict[str, Lexicon]:
    """A ``Lexicon`` per lang from collected rows of ``build``."""
    langs: dict[str, list] = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    return {lang: Lexicon(part) for lang, part in langs.items()}
