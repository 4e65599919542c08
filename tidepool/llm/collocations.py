"""Phrase collocations by SON partitioning: exact counts of frequent phrases,
scored by how much more often their parts meet than by chance.

Words are runs without space or tab of lower-cased (A-Z) texts; phrases of 2
to ``LONGEST`` words lie within pieces, which end at ``.,;:!?`` and line ends.
Everything is per lang; null is ``und``.

1. *Words* are counted exactly; only those found ``min_count`` times can be
   part of a frequent phrase.  They are numbered by perfect hashes.
2. *Shards.*  A task cuts its documents into shards of about ``SHARD_WORDS``
   words.  A shard with a share of a lang's words is mined completely, level by
   level, at that share of ``min_count``, rounded up.  A phrase frequent in all
   is frequent in some shard.
3. *Candidates.*  A shard sends its frequent phrases with their counts.  Where
   it sends none, the phrase occurs less often there than its local support;
   phrases whose counts and these remainders add up to less than ``min_count``
   are dropped, the others are the candidates.
4. *Recount.*  A pass over all texts counts every candidate exactly, in a trie
   of sorted whole-number keys.

Words and trie are broadcast up to ``BROADCAST_BYTES`` each.  Beyond that
``plain_counts`` counts all phrases with a shuffle: the same rows, dearer.
With more than ``min_count`` shards to a lang the local support is 1, so all
phrases of frequent words travel once, thousands to a line.

Defined cases: null and empty texts have no words; repeated rows count each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import perfect_hash
from .common import materialize, small_join
from .divergence import by_value
from .words import Words, mix, text_blocks

MIN_COUNT = 100
LONGEST = 5
TOP = 2000

SHARD_WORDS = 6_000_000
BLOCK_BYTES = 1 << 20            # text that is cut into words at once
PART = 1 << 19                   # places of a shard that are sorted at once
BROADCAST_BYTES = 64 << 20
BUCKET_WORDS = 1 << 21           # words of the corpus per bucket of phrases, about
FEWEST_BUCKETS, MOST_BUCKETS = 64, 1 << 20
SLOTS = 1 << 14                  # candidates in a block of counts: 16-bit positions

# fixed value: characters that end a piece
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"

ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in PIECE_ENDS]] = True
BYTES = np.arange(256, dtype=np.uint8)
BYTES[65:91] += 32
BYTES[ENDS] = 0x20


def _known(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_counts(documents: DataFrame) -> DataFrame:
    """``lang, word, count``; the null word has the number of all words."""

    def run(batches):
        for batch in batches:
            for lang, rows in by_value(batch, "lang"):
                for _, _, data, offsets in text_blocks(rows["text"]):
                    words = Words(BYTES[data], offsets)
                    number, first = perfect_hash.numbered(words)
                    count = np.append(np.bincount(number, minlength=len(first)), len(number))
                    word = pa.concat_arrays([perfect_hash.strings(words, first), pa.nulls(1, pa.string())])
                    yield pa.record_batch([pa.array([lang] * len(count)), word, pa.array(count)], names=["lang", "word", "count"])

    return documents.mapInArrow(run, "lang string, word string, count long") \
        .groupBy("lang", "word").agg(F.sum("count").alias("count"))


class Vocabulary:
    """The frequent words of all langs, numbered through."""

    def __init__(self, rows: list, totals: dict[str, int]):
        self.lexicons = perfect_hash.load(rows)
        self.langs = sorted(self.lexicons)
        self.totals = totals
        sizes = [int(self.lexicons[lang].number.max()) + 1 for lang in self.langs]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def stream(self, batches):
        """``(lang number or -1, words, numbers)`` per block: the numbers of a
        block's words in order, -1 for rare ones and between pieces."""
        place = {lang: i for i, lang in enumerate(self.langs)}
        for batch in batches:
            for lang, rows in by_value(batch, "lang"):
                at = place.get(lang, -1)
                if at < 0:
                    continue
                for _, _, data, offsets in text_blocks(rows["text"], BLOCK_BYTES):
                    n, out = self._numbers(at, data, offsets)
                    if n:
                        yield at, n, out

    def _numbers(self, at: int, data: np.ndarray, offsets: np.ndarray) -> tuple[int, np.ndarray | None]:
        words = Words(BYTES[data], offsets)
        n = len(words.hash)
        if not n:
            return 0, None
        ends = np.concatenate([[0], np.cumsum(ENDS[data])])[words.start] + words.doc
        shift = np.cumsum(np.diff(ends, prepend=ends[0] - 1) > 0)
        out = np.full(n + int(shift[-1]) + 1, -1, dtype=np.int32)
        slot = self.lexicons[self.langs[at]].lookup(words)
        out[np.arange(n) + shift] = np.where(slot >= 0, slot + self.first[at], -1)
        return n, out

    def lang_of(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, ids, side="right") - 1

    def words(self) -> np.ndarray:
        """All words by number, as UTF-8."""
        out = np.empty(int(self.first[-1]), dtype=object)
        for i, lang in enumerate(self.langs):
            x = self.lexicons[lang]
            raw = x.keys.tobytes()
            out[self.first[i] + x.number] = [raw[a:a + n] for a, n in zip(x.key_at.tolist(), x.length.tolist())]
        return out


def _alive(node: np.ndarray, k: int) -> np.ndarray:
    """Places where both parts of ``k - 1`` words are alive."""
    pos = np.flatnonzero((node[:-1] >= 0) & (node[1:] >= 0))
    return pos[pos + k <= len(node)]


def _key(node: np.ndarray, x: np.ndarray, pos: np.ndarray, k: int) -> np.ndarray:
    """The number of the first ``k - 1`` words and the last word."""
    return (node[pos].astype(np.int64) << np.int64(32)) | x[pos + k - 1]


def mine(x: np.ndarray, need: np.ndarray, lang_of, longest: int):
    """``(words of the phrases, counts, local support)``, part by part: phrases
    of the stream ``x`` with at least ``need[lang]`` occurrences."""
    node = x
    for k in range(2, longest + 1):
        places = _alive(node, k)
        parts = max(1, len(places) // PART)
        after, found = np.full(len(x), -1, dtype=np.int32), 0
        for part in range(parts):
            pos = places if parts == 1 else places[node[places] % parts == part]
            if not len(pos):
                continue
            _, first, number, count = np.unique(_key(node, x, pos, k), return_index=True, return_inverse=True, return_counts=True)
            support = need[lang_of(x[pos[first]])]
            alive = count >= support
            rep = pos[first[alive]]
            yield np.stack([x[rep + j] for j in range(k)], axis=1), count[alive], support[alive]
            stay = alive[number]
            after[pos[stay]] = found + (np.cumsum(alive) - 1)[number[stay]]
            found += len(rep)
        if not found:
            return
        node = after


def _pack(ids: np.ndarray, gain: np.ndarray, buckets: int) -> Iterator[tuple]:
    """``(bucket, phrases, gains)`` of phrases of one length as bytes: their
    words' numbers, four big-endian bytes each, and eight per gain."""
    h = np.zeros(len(ids), dtype=np.uint64)
    for j in range(ids.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[:, j].astype(np.uint64))
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    bucket, ids, gain = bucket[order], ids[order].astype(">u4"), gain[order].astype("<i8")
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for i, j in zip(cut, np.append(cut[1:], len(ids))):
        yield int(bucket[i]), ids[i:j].tobytes(), gain[i:j].tobytes()


PACKED = "bucket int, k int, lang int, phrases binary, gains binary"
PACKED_KINDS = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def candidates(documents: DataFrame, shared, min_count: int, longest: int, shard_words: int, buckets: int) -> DataFrame:
    """``phrase``: what may occur ``min_count`` times, from the shards.  A
    line of a shard holds its frequent phrases of one length and bucket."""

    def run(batches):
        vocabulary = shared.value
        total = np.array([vocabulary.totals[lang] for lang in vocabulary.langs], dtype=object)

        def batch(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), PACKED_KINDS)],
                                   names=[c.split()[0] for c in PACKED.split(", ")])

        def shard(parts, held):
            need = np.array([max(1, -(-min_count * int(h) // t)) for h, t in zip(held, total)], dtype=np.int64)
            used = np.flatnonzero(held)
            # where a shard does not send a phrase, it occurs so often at most
            yield batch([(0, 1, int(i), None, int(need[i] - 1).to_bytes(8, "little")) for i in used])
            x = np.concatenate(parts)
            parts.clear()
            for ids, count, support in mine(x, need, vocabulary.lang_of, longest):
                if len(ids):
                    k = ids.shape[1]
                    rows = [(b, k, None, p, g) for b, p, g in _pack(ids, count - support + 1, buckets)]
                    for a in range(0, len(rows), 256):
                        yield batch(rows[a:a + 256])

        parts, held = [], np.zeros(len(vocabulary.langs), dtype=np.int64)
        for lang, n, numbers in vocabulary.stream(batches):
            parts.append(numbers)
            held[lang] += n
            if held.sum() >= shard_words:
                yield from shard(parts, held)
                parts, held = [], np.zeros(len(vocabulary.langs), dtype=np.int64)
        if parts:
            yield from shard(parts, held)

    mined = materialize(documents.mapInArrow(run, PACKED), "phrases-mined")
    below = mined.filter("k = 1").groupBy("lang").agg(F.sum(F.conv(F.hex(F.reverse("gains")), 16, 10).cast("long")).alias("below"))
    remainder = {r["lang"]: r["below"] for r in below.collect()}        # a line per lang of the vocabulary

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        phrases, gains, k = [], [], 2
        for b in batches:
            k = b["k"][0].as_py()
            phrases += b["phrases"].to_pylist()
            gains += b["gains"].to_pylist()
        packed = np.frombuffer(b"".join(phrases), dtype=f"V{4 * k}")
        gain = np.frombuffer(b"".join(gains), dtype="<i8")
        ids = packed.view(">u4").reshape(-1, k)
        order = np.lexsort(ids.T[::-1])
        packed, ids = packed[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1)]))
        most = np.add.reduceat(gain[order], first)
        lang = vocabulary.lang_of(ids[first, 0].astype(np.int64))
        keep = most + np.array([remainder[i] for i in lang.tolist()], dtype=np.int64) >= min_count
        yield pa.record_batch([pa.array(packed[first[keep]].tolist(), pa.binary())], names=["phrase"])

    return mined.filter("k > 1").groupBy("bucket", "k").applyInArrow(add, "phrase binary")


class Trie:
    """Candidates by length: sorted keys of (place of the first words, word)."""

    def __init__(self, phrases: list[bytes], longest: int):
        self.keys: dict[int, np.ndarray] = {}
        by_length: dict[int, list[bytes]] = {}
        for p in phrases:
            by_length.setdefault(len(p) // 4, []).append(p)
        for k in range(2, longest + 1):
            ids = np.frombuffer(b"".join(by_length.get(k, [])), dtype=">u4").astype(np.int64).reshape(-1, k)
            self.keys[k] = np.unique((self._place(ids[:, :-1]) << np.int64(32)) | ids[:, -1])

    def _place(self, ids: np.ndarray) -> np.ndarray:
        place = ids[:, 0]
        for k in range(2, ids.shape[1] + 1):
            place = np.searchsorted(self.keys[k], (place << np.int64(32)) | ids[:, k - 1])
        return place

    def count(self, x: np.ndarray, counts: dict[int, np.ndarray]) -> None:
        """Adds the occurrences of candidates in a stream to ``counts``."""
        node = x
        for k, keys in self.keys.items():
            places = _alive(node, k)
            if not len(places) or not len(keys):
                return
            after = np.full(len(x), -1, dtype=np.int32)
            for a in range(0, len(places), PART):
                pos = places[a:a + PART]
                key = _key(node, x, pos, k)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                after[pos[hit]] = at[hit]
            node = after
            counts[k] += np.bincount(node[node >= 0], minlength=len(keys))

    def ids(self, k: int, place: np.ndarray) -> np.ndarray:
        """The words of candidates of ``k`` words by place."""
        out = np.empty((len(place), k), dtype=np.int64)
        for j in range(k, 1, -1):
            key = self.keys[j][place]
            out[:, j - 1], place = key & np.int64(0xFFFFFFFF), key >> np.int64(32)
        out[:, 0] = place
        return out


def _recount(documents: DataFrame, shared, trie, min_count: int) -> DataFrame:
    """``k, place, count`` of the candidates with ``min_count`` occurrences or
    more.  A task counts in dense slots and sends them in blocks, as positions
    and counts side by side; a block's lines are added up one batch at a time."""
    def run(batches):
        vocabulary, tree = shared.value, trie.value
        counts = {k: np.zeros(len(keys), dtype=np.int64) for k, keys in tree.keys.items()}
        for _, _, numbers in vocabulary.stream(batches):
            tree.count(numbers, counts)
        for k, c in counts.items():
            for block in range(-(-len(c) // SLOTS)):
                part = c[block * SLOTS:(block + 1) * SLOTS]
                at = np.flatnonzero(part)
                if len(at):
                    row = [[k], [block], [at.astype(np.uint16).tobytes()], [part[at].tobytes()]]
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(row, kinds)], names=["k", "block", "at", "n"])

    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, k, block = np.zeros(SLOTS, dtype=np.int64), 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                k, block = r["k"], r["block"]
                total[np.frombuffer(r["at"], np.uint16)] += np.frombuffer(r["n"], np.int64)
        at = np.flatnonzero(total >= min_count)
        yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(block * np.int64(SLOTS) + at),
                               pa.array(total[at])], names=["k", "place", "count"])

    return documents.mapInArrow(run, "k int, block int, at binary, n binary") \
        .groupBy("k", "block").applyInArrow(add, "k int, place long, count long")


def _named(counted: DataFrame, shared, trie) -> DataFrame:
    """Counts by lang and phrase instead of place in the trie."""
    def run(batches):
        vocabulary, tree = shared.value, trie.value
        words = vocabulary.words()
        for batch in batches:
            ks, places = np.asarray(batch["k"]), np.asarray(batch["place"])
            for k in np.unique(ks):
                rows = np.flatnonzero(ks == k)
                ids = tree.ids(int(k), places[rows])
                phrase = [b" ".join(words[i]).decode() for i in ids]
                lang = [vocabulary.langs[i] for i in vocabulary.lang_of(ids[:, 0])]
                yield pa.record_batch([pa.array(lang), pa.array(phrase), pa.array(np.full(len(rows), k, np.int32)),
                                       batch["count"].take(pa.array(rows))], names=["lang", "phrase", "k", "f"])

    return counted.mapInArrow(run, "lang string, phrase string, k int, f long")


def plain_counts(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, k, f`` of all phrases with ``min_count`` occurrences or
    more, by counting every phrase."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    piece = F.explode(F.split(F.translate("text", upper, upper.lower()), r"[.,;:!?\x0A-\x0D]")).alias("piece")
    words = F.regexp_extract_all("piece", F.lit(r"[^\x20\x09]+"), F.lit(0)).alias("w")
    each = documents.select("lang", piece).select("lang", words).filter("size(w) > 0") \
        .select("lang", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("at")) \
        .select("lang", "w", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.size("w") - F.col("at") + 1))).alias("k"))
    phrase = F.array_join(F.slice("w", F.col("at"), F.col("k")), " ").alias("phrase")
    return each.select("lang", phrase, "k").groupBy("lang", "phrase", "k").agg(F.count("*").alias("f")) \
        .filter(F.col("f") >= min_count)


def phrase_counts(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST,
                  shard_words: int = SHARD_WORDS, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, k, f)`` of phrases of 1 to ``longest`` words with at
    least ``min_count`` occurrences, and ``(lang, n)``, the words of a lang."""
    spark = documents.sparkSession
    docs = _known(documents)
    words = materialize(word_counts(docs).filter((F.col("count") >= min_count) | F.col("word").isNull()), "phrases-words")
    totals = words.filter("word is null").select("lang", F.col("count").alias("n"))
    singles = words.filter("word is not null").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"),
                                                      F.col("count").alias("f"))
    lexicon = perfect_hash.build(words.filter("word is not null"), "phrases")
    size = lexicon.agg(F.sum(perfect_hash.stored_bytes(F.col("n"), F.col("bits"), F.col("keys")))).first()[0]
    if size is None:
        return singles, totals
    if size > limit:
        return materialize(plain_counts(docs, min_count, longest), "phrases-plain"), totals
    frequent = F.broadcast(lexicon.select("lang").distinct())
    shared = spark.sparkContext.broadcast(Vocabulary(
        lexicon.collect(), {r["lang"]: r["n"] for r in totals.join(frequent, "lang").collect()}))
    number = sum(shared.value.totals.values())
    buckets = int(min(MOST_BUCKETS, max(FEWEST_BUCKETS, number // BUCKET_WORDS)))
    found = materialize(candidates(docs, shared, min_count, longest, shard_words, buckets), "phrases-candidates")
    size = found.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    if size > limit:
        return materialize(plain_counts(docs, min_count, longest), "phrases-plain"), totals
    trie = spark.sparkContext.broadcast(Trie(found.toArrow()["phrase"].to_pylist(), longest))
    # written: one kind of Python worker at a time in an executor
    counted = materialize(_recount(docs, shared, trie, min_count), "phrases-recounted")
    return materialize(singles.unionByName(_named(counted, shared, trie)), "phrases-counts"), totals


def score(counts: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` collocations of each lang by the score of their
    weakest cut: ``floor(1000 * a * n / (l * r))``, in exact decimals."""
    found = counts.filter("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    part = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = small_join(cuts.join(part, ["lang", "left"]).join(rest, ["lang", "right"]), totals, ["lang"])
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    strength = F.call_function("div", whole["a"] * whole["n"] * F.lit(1000), whole["l"] * whole["r"])
    best = cuts.withColumn("score", strength).groupBy("lang", "phrase", "a", "n") \
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inner = found.filter("k >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1))) \
        .select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = best.join(inner, ["lang", "phrase"], "left").filter("longer is null or longer < a") \
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return alone.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 shard_words: int = SHARD_WORDS, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the strongest collocations."""
    return score(*phrase_counts(documents, min_count, longest, shard_words, limit), top)
