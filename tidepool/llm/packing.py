"""Packing documents into token windows by lexical retrieval.

A document is its token ids and one end id.  Its full windows of ``LENGTH``
tokens are sequences of their own; what is left, its tail, is packed with
lexically near tails.  Documents are put in order of their rarest terms that
another document has too (``RARE`` of them, rarest first), and this order is cut
into shards of about ``SHARD_ROWS`` rows, so documents that share their rarest
terms meet in one shard.  A shard keeps a BM25 inverted index over whole
documents (terms: token ids; document frequencies and mean length over all
documents, a table no larger than the vocabulary).  Each unused tail in turn
seeds a window: all its terms ask the index for unused neighbours, which fill
the window in order of score.  The neighbour that does not fit is
cut where the window ends and its rest stays in the pool.  When no neighbour
is left, the next unused tails fill up, so only a shard's last window can be
short.

Ids come from a ``tokenizers`` file.  When its merges are numbered in order
(checked), texts are encoded by ``tiktoken`` with ranks read from the same
file, which gives the same ids faster; texts with a very long word go through
``tokenizers`` itself, loaded when the first one comes.  A special token's string
in a text is ordinary text.  Ids are stored in two bytes when the vocabulary
allows, counts in as few as they need, and only documents with full windows send
their terms to the shard: those of the others are counted from the tail there.
Shards are dealt to partitions by their number, so partitions are about equal.

Defined cases: a null text is an empty one (its only token is the end id);
repeated rows are documents of their own; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .words import mix

LENGTH = 1024
END_ID = 0
SHARD_ROWS = 4096
DENSE = 16                       # a term in more than one of so many documents of a shard is frequent there
RARE = 6                         # rarest terms that place a document
SAMPLE = 100                     # places per shard that its bounds are taken from, about
K1, B = 1.2, 0.75
NONE = 0xFFFFFFFF                # rank of a term that no other document has
LONG_TEXT, LONG_WORD = 20_000, re.compile(r"\S{4000}")
# fixed value: the part of the split pattern that tells the last of several
# white space characters from the others, and what it is about
LAST_SPACE, SPACES = r"\s+(?!\S)|", re.compile(r"\s\s")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable Latin-1 characters for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of a text as ``tokenizers`` gives them (no special tokens
    added)."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast, self.plain = self._ranks(spec)

    @functools.cached_property
    def slow(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        slow = Tokenizer.from_file(self.path)
        slow.encode_special_tokens = True               # their strings in a text are ordinary text
        return slow

    @staticmethod
    def _ranks(spec):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                 and spec.get("normalizer") is None and not model.get("continuing_subword_prefix"))
        if not plain:
            return None, None
        letters = _byte_letters()
        vocab = model["vocab"]
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        if any(b <= a for a, b in zip(merged, merged[1:])):
            return None, None
        added = {t["content"] for t in spec["added_tokens"]}
        try:
            import public_tokenizers
            import tiktoken
            ranks = {bytes(letters[c] for c in word): i for word, i in vocab.items() if word not in added}
        except (ImportError, KeyError):
            return None, None
        # without the look-ahead the pattern splits faster, and alike where no
        # two white space characters meet
        full = public_tokenizers.PATTERN
        return tuple(tiktoken.Encoding("packing", pat_str=p, mergeable_ranks=ranks, special_tokens={})
                     for p in (full, full.replace(LAST_SPACE, "")))

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or (len(text) > LONG_TEXT and LONG_WORD.search(text)):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        encoding = self.fast if SPACES.search(text) else self.plain
        return np.frombuffer(encoding._core_bpe.encode_to_tiktoken_buffer(text, set()), dtype=np.uint32)


def term_counts(texts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct ids of each text, rising, and how often each occurs; all
    texts are sorted at once by (text, id)."""
    n = np.array([len(t) for t in texts])
    ids = np.concatenate(texts) if len(texts) else np.zeros(0, np.uint32)
    kind = np.uint32 if len(texts) <= 256 and (not len(ids) or ids.max() < 1 << 24) else np.uint64
    shift = kind(24 if kind is np.uint32 else 32)
    key = np.repeat(np.arange(len(texts), dtype=kind) << shift, n) | ids.astype(kind)
    key.sort()
    ends = np.flatnonzero(np.append(key[1:] != key[:-1], True)) + 1 if len(key) else np.zeros(0, np.int64)
    key, counts = key[ends - 1], np.diff(ends, prepend=0).astype(np.uint32)
    cut = np.searchsorted(key >> shift, np.arange(len(texts) + 1, dtype=kind))
    terms = (key & ((kind(1) << shift) - kind(1))).astype(np.uint32)
    return [(terms[a:b], counts[a:b]) for a, b in zip(cut, cut[1:])]


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    """The ``Encoder`` of a file, read once per Python worker."""
    return Encoder(path)


def id_type(path: str) -> np.dtype:
    """The type that ids of a ``tokenizers`` file are stored in."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return np.dtype("<u2" if max(Tokenizer.from_file(path).get_vocab().values(), default=0) < 1 << 16 else "<u4")


def narrow(counts: np.ndarray) -> bytes:
    """Counts as unsigned integers of as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(counts.max(initial=0)).newbyteorder("<")).tobytes()


def wide(counts: bytes, n: int) -> np.ndarray:
    """The ``n`` counts of ``narrow``."""
    return np.frombuffer(counts, f"<u{len(counts) // n}").astype(np.uint32) if n else np.zeros(0, np.uint32)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


TOKENS = ("row long, doc_id long, n_tokens long, full_crc array<long>, full_ids array<binary>, tail binary, "
          "terms binary, counts binary")


def tokenized(documents: DataFrame, tokenizer: str, kind: np.dtype, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per document: checksums (and ids) of its full windows, its tail
    and its terms (ids as ``kind``) with their counts.  Written once; ``row`` is
    unique."""

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                texts = [encode(text or "") for text in part["text"].to_pylist()]
                for ids, (terms, counts) in zip(texts, term_counts(texts)):
                    ids = np.append(ids, np.uint32(END_ID)).astype(kind)
                    full = len(ids) // length
                    windows = [ids[i * length:(i + 1) * length] for i in range(full)]
                    out.append((len(ids), [crc(w) for w in windows],
                                [w.tobytes() for w in windows] if with_ids else None,
                                ids[full * length:].tobytes(), terms.astype(kind).tobytes(), narrow(counts)))
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.binary()]
                cols = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.record_batch([part["row"], part["doc_id"], *cols],
                                      names=["row", "doc_id", "n_tokens", "full_crc", "full_ids", "tail", "terms", "counts"])

    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(run, TOKENS), "pack-tokens")


def document_frequencies(rows: DataFrame, kind: np.dtype) -> tuple[np.ndarray, int, float]:
    """Documents per term (an array as long as the vocabulary), number of
    documents and their mean length, over all rows."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            col = batch["terms"]
            terms = np.frombuffer(b"".join(col.to_pylist()), kind)
            n = np.bincount(terms, minlength=len(total))
            n[:len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["term", "n"])

    per = rows.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(max((r[0] for r in per), default=-1) + 1, dtype=np.int64)
    for term, n in per:
        df[term] = n
    docs, mean = rows.agg(F.count("*"), F.avg("n_tokens")).first()
    return df, docs, mean or 1.0


def places(row: np.ndarray, terms: list[bytes], rank: np.ndarray, kind: np.dtype) -> np.ndarray:
    """What documents are ordered by: the ranks of their ``RARE`` rarest terms
    and a hash of the row, which parts equal texts, as bytes that sort alike."""
    out = np.full((len(terms), RARE + 2), NONE, dtype=">u4")
    for i, t in enumerate(terms):
        r = rank[np.frombuffer(t, kind)]
        r = np.sort(np.partition(r, RARE)[:RARE] if len(r) > RARE else r)
        out[i, :len(r)] = r
    out[:, RARE:] = mix(row.astype(np.uint64)).astype(">u8").view(">u4").reshape(-1, 2)
    return out.view(f"S{4 * (RARE + 2)}").ravel()


def dealt(rows: DataFrame, df: np.ndarray, docs: int, shards: int, kind: np.dtype) -> DataFrame:
    """``rows`` with ``shard``: the order of ``places`` cut into equal parts.
    The cuts come from a sample by hash, so shards differ a little in size."""
    if shards == 1:
        return rows.withColumn("shard", F.lit(0).cast("long"))
    spark = rows.sparkSession
    order = np.lexsort((mix(np.arange(len(df), dtype=np.uint64)), df))
    rank = np.empty(len(df), dtype=np.uint32)
    rank[order] = np.arange(1, len(df) + 1)
    rank[df < 2] = NONE                                          # no other document has it
    sent = spark.sparkContext.broadcast(rank)

    def sample(batches):
        for b in batches:
            at = places(b["row"].to_numpy(), b["terms"].to_pylist(), sent.value, kind)
            yield pa.record_batch([pa.array([x.ljust(4 * (RARE + 2), b"\0") for x in at.tolist()], pa.binary())],
                                  names=["place"])

    part = max(1, docs // (shards * SAMPLE))
    some = rows.select("row", "terms").filter(F.pmod(F.xxhash64("row"), F.lit(part)) == 0)
    found = np.sort(np.array([bytes(r[0]) for r in some.mapInArrow(sample, "place binary").collect()],
                             dtype=f"S{4 * (RARE + 2)}"))
    bounds = spark.sparkContext.broadcast(found[np.arange(1, shards) * len(found) // shards])

    def shard(batches):
        for b in batches:
            at = places(b["row"].to_numpy(), b["terms"].to_pylist(), sent.value, kind)
            yield b.append_column("shard", pa.array(np.searchsorted(bounds.value, at, side="right").astype(np.int64)))

    return rows.mapInArrow(shard, f"{TOKENS}, shard long")


class Index:
    """BM25 inverted index of one shard.  Rare terms keep postings; the weights
    of a term that ``1 / DENSE`` of the shard's documents have stand in a full
    row, so a query adds rows instead of long postings.  Rows lose the columns
    of used documents whenever a quarter of them are used."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], df: np.ndarray, docs: int, mean: float):
        n = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(len(terms)), n)
        term = np.concatenate(terms) if len(terms) else np.zeros(0, np.uint32)
        tf = (np.concatenate(counts) if len(counts) else np.zeros(0, np.uint32)).astype(np.float32)
        size = np.array([c.sum() for c in counts], dtype=np.float32)
        idf = np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / np.float32(mean)))
        order = np.argsort(term, kind="stable")
        self.rows = len(terms)
        here = np.bincount(term, minlength=len(df)) if len(term) else np.zeros(len(df), np.int64)
        frequent = np.flatnonzero(here * DENSE > self.rows)
        place = np.full(len(df), -1, dtype=np.int32)
        place[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.rows), dtype=np.float32)
        at = place[term]
        self.dense[at[at >= 0], doc[at >= 0]] = weight[at >= 0]
        self.dense_rows, self.columns = list(self.dense), np.arange(self.rows)
        order = order[at[order] < 0]
        self.doc, self.weight = doc[order], weight[order].astype(np.float64)
        self.first = np.searchsorted(term[order], np.arange(len(df) + 1))
        self.frequent, self.rare = [], []
        ends = np.cumsum(n)
        for a, b in zip(ends - n, ends):
            t, p = term[a:b], at[a:b]
            self.frequent.append(p[p >= 0])
            self.rare.append(t[(p < 0) & (here[t] > 1)])

    def scores(self, doc: int, unused: np.ndarray) -> np.ndarray:
        """BM25 scores of the unused documents for all terms of ``doc``, itself
        left out; 0 for the others."""
        if 4 * np.count_nonzero(unused) < 3 * len(self.columns):
            left = unused[self.columns]
            self.dense, self.columns = np.ascontiguousarray(self.dense[:, left]), self.columns[left]
            self.dense_rows = list(self.dense)
        spans = list(zip(self.first[self.rare[doc]], self.first[self.rare[doc] + 1]))
        score = (np.bincount(np.concatenate([self.doc[a:b] for a, b in spans]),
                             np.concatenate([self.weight[a:b] for a, b in spans]), self.rows)
                 if spans else np.zeros(self.rows))
        total = np.zeros(len(self.columns), dtype=np.float32)
        for term in self.frequent[doc].tolist():                # row after row, without a copy of the rows
            np.add(total, self.dense_rows[term], total)
        score[self.columns] += total
        score[~unused] = 0
        score[doc] = 0
        return score

    def neighbours(self, doc: int, unused: np.ndarray):
        """Unused documents that share a term, best score first, then in order
        of place; found a few at a time."""
        score = self.scores(doc, unused)
        some = 16
        while score.any():
            bound = np.partition(score, -some)[-some] if some < len(score) else 0
            found = np.flatnonzero(score >= bound) if bound > 0 else np.flatnonzero(score)
            yield from found[np.argsort(-score[found], kind="stable")]
            score[found] = 0
            some *= 8


def to_shards(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of ``dealt`` in ``parts`` partitions by the number of their shard, each
    in order of shards, with terms and counts only where the tail is not the
    whole document."""
    sent = {c: F.when(F.size("full_crc") > 0, F.col(c)).alias(c) for c in ("terms", "counts")}
    return (rows.select([sent.get(c, c) for c in rows.columns])
            .repartitionById(parts, F.pmod("shard", F.lit(parts)).cast("int")).sortWithinPartitions("shard"))


def by_shard(batches):
    """Batches in order of shards as (shard, table) of whole shards."""
    held, at = [], None
    for batch in batches:
        shard = batch["shard"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and shard[a] != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = int(shard[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield at, pa.Table.from_batches(held)


PIECES = ("doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")


def shard_terms(table: pa.Table, tails: list[np.ndarray], kind: np.dtype) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Terms and counts of a shard's documents: as sent, or counted from a tail
    that is the whole document."""
    out = [None if t is None else (np.frombuffer(t, kind).astype(np.uint32), wide(c, len(t) // kind.itemsize))
           for t, c in zip(table["terms"].to_pylist(), table["counts"].to_pylist())]
    left = [d for d, x in enumerate(out) if x is None]
    for at in range(0, len(left), 256):
        some = left[at:at + 256]
        for d, found in zip(some, term_counts([tails[d][:-1].astype(np.uint32) for d in some])):
            out[d] = found
    return [t for t, _ in out], [c for _, c in out]


def pack_shard(shard: int, table: pa.Table, df: np.ndarray, docs: int, mean: float, length: int, with_ids: bool,
               kind: np.dtype):
    """The pieces of a shard's documents as rows of ``PIECES``."""
    table = table.sort_by([("doc_id", "ascending"), ("row", "ascending")])
    col = {c: table[c].to_pylist() for c in ("doc_id", "row", "n_tokens", "full_crc", "full_ids", "tail")}
    tails = [np.frombuffer(t, kind) for t in col["tail"]]
    out, base, seq = [], shard << 32, 0

    def piece(d, start, ids, n, check, offset):
        out.append((col["doc_id"][d], col["row"][d], start, n, check, col["n_tokens"][d], base + seq, offset,
                    ids.astype("<u4").tobytes() if with_ids else None))

    for d, checks in enumerate(col["full_crc"]):
        for i, c in enumerate(checks):
            piece(d, i * length, np.frombuffer(col["full_ids"][d][i], kind) if with_ids else None, length, c, 0)
            seq += 1
    index = Index(*shard_terms(table, tails, kind), df, docs, mean)
    at = np.zeros(len(tails), dtype=np.int64)                   # tokens of a tail that are placed
    size = np.array([len(t) for t in tails], dtype=np.int64)
    unused = size > 0
    cursor = 0

    def place(d, room, offset):
        n = min(room, size[d] - at[d])
        ids = tails[d][at[d]:at[d] + n]
        piece(d, col["n_tokens"][d] - size[d] + at[d], ids, n, crc(ids), offset)
        at[d] += n
        unused[d] = at[d] < size[d]
        return n

    seed = -1
    while True:
        if seed < 0 or not unused[seed]:
            while cursor < len(tails) and not unused[cursor]:
                cursor += 1
            if cursor == len(tails):
                break
            seed = cursor
        filled = place(seed, length, 0)
        cut = -1
        for d in index.neighbours(seed, unused):
            if filled == length:
                break
            filled += place(d, length - filled, filled)
            cut = d if unused[d] else -1
        while filled < length:
            while cursor < len(tails) and not unused[cursor]:
                cursor += 1
            if cursor == len(tails):
                break
            d = cursor
            filled += place(d, length - filled, filled)
            cut = d if unused[d] else -1
        seq += 1
        seed = cut                                              # the rest of the cut tail goes on
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 9, kinds)], names=names)


def pack(documents: DataFrame, tokenizer: str | None = None, length: int = LENGTH, shard_rows: int = SHARD_ROWS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece (``PIECES``); ``with_ids`` also returns its ids as
    little-endian unsigned 32-bit integers."""
    tokenizer = tokenizer or default_tokenizer()
    kind = id_type(tokenizer)
    rows = tokenized(documents, tokenizer, kind, length, with_ids)
    df, docs, mean = document_frequencies(rows, kind)
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast((df, docs, mean))

    def run(batches):
        for shard, table in by_shard(batches):
            yield from pack_shard(shard, table, *sent.value, length, with_ids, kind).to_batches()

    shards = max(1, -(-docs // shard_rows))
    parts = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return to_shards(dealt(rows, df, docs, shards, kind), parts).mapInArrow(run, PIECES)
