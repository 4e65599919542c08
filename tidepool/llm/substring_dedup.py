"""Substring dedup on a De Bruijn graph of word k-mers.

Every window of ``K`` words is an edge of the graph (its first and last
``K - 1`` words are the nodes).  An edge that two documents share is named by
its source coordinate: the smallest document and position where it starts.

1. *Edges.*  Windows go to buckets by their minimizer, the smallest hash of
   their ``MINI``-word parts, so neighbouring windows travel together as one
   packed run (a run of r windows needs one minimizer and r short hashes).
   Windows that a block of documents holds twice are settled in the block:
   only the smallest document's stays, the others point to it.  A bucket finds
   each shared edge's source and answers with pieces: stretches of a document
   whose edges have consecutive source coordinates.
2. *Compaction.*  Pieces are joined where one ends and the next begins.  Where
   the joint does not branch (the next source coordinate follows on), they
   become one path; the paths so compacted are the repeated spans.
3. *Verification.*  The text of each span and of its source coordinates is
   digested.  Where a digest is not that of its source (equal hashes of
   different words), all windows with the hashes of that stretch are read from
   all texts and grouped by the digest of their words: each digest gets its own
   smallest source.  Only documents with such spans are written again.
4. *Removal.*  A word goes when a span of its document covers it whose source
   document is smaller.

Defined cases: a null text has no words; texts below ``K`` words lose nothing;
an empty table gives no rows; extra columns are ignored by ``report`` and kept
by ``remove``.  Rows with an equal or null doc_id are ordered by their place
in the input, nulls last, and an earlier one counts as smaller.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, total_bytes, with_row_ids
from .words import Words, mix, text_blocks

K = 13
MINI = 5
RUN = 128                        # windows of a packed run at most
BUCKET = 1 << 17                 # windows per bucket, about
SHORT = 6                        # bytes of a window's hash that travel
HASH_BITS = 64                   # bits of a window's hash that count (fewer in tests)
KEYS = 1 << 20                   # colliding hashes looked for in one pass over the texts

PACKED = "bucket long, doc binary, pos binary, len binary, mini binary, win binary, src_doc binary, src_pos binary"
NAMES = [c.split()[0] for c in PACKED.split(", ")]
KINDS = [pa.int64()] + [pa.binary()] * 7
PIECES = "doc long, pos long, len long, src_doc long, src_pos long"
PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each place on."""
    done = 1
    m = x
    while done * 2 <= width:
        m = np.minimum(m[:len(m) - done], m[done:])
        done *= 2
    rest = width - done
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def _pieces(doc, pos, src_doc, src_pos):
    """Runs of consecutive windows with consecutive source coordinates."""
    order = np.lexsort((pos, doc))
    doc, pos, src_doc, src_pos = doc[order], pos[order], src_doc[order], src_pos[order]
    head = np.ones(len(doc), dtype=bool)
    head[1:] = ((doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (src_doc[1:] != src_doc[:-1])
                | (src_pos[1:] != src_pos[:-1] + 1))
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(doc)))
    return doc[at], pos[at], size, src_doc[at], src_pos[at]


def _sources(key: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """``(at, source)``: the windows of keys that several documents share, and
    the window with the smallest document and position of the same key."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    twice = np.zeros(len(k), dtype=bool)
    same = k[1:] == k[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    at = order[twice]
    if not len(at):
        return at, at
    at = at[np.lexsort((pos[at], doc[at], key[at]))]
    first = np.ones(len(at), dtype=bool)
    first[1:] = key[at[1:]] != key[at[:-1]]
    heads = np.flatnonzero(first)
    source = at[np.repeat(heads, np.diff(np.append(heads, len(at))))]
    last = doc[at[np.append(heads[1:], len(at)) - 1]]
    shared = np.repeat(last != doc[at[heads]], np.diff(np.append(heads, len(at))))
    return at[shared], source[shared]


def _windows(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's windows and whether they lie in one text."""
    win, inside = words.grams(K)
    return win & np.uint64((1 << bits) - 1), inside


def _short(win: np.ndarray) -> np.ndarray:
    return win & np.uint64((1 << 8 * SHORT) - 1)


def pack_block(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, buckets: int, bits: int = HASH_BITS):
    """A block's windows as packed runs per bucket, and the pieces settled in
    the block."""
    words = Words(data, offsets)
    win, inside = _windows(words, bits)
    if not inside.any():
        return
    parts, _ = words.grams(MINI)
    mini = _smallest(parts, K - MINI + 1)[:len(win)]
    at = np.flatnonzero(inside)
    doc, pos = ids[words.doc[at]], words.pos[at]
    win, mini = win[at], mini[at]
    hit, source = _sources(win, doc, pos)
    settled = doc[source] < doc[hit]
    hit, source = hit[settled], source[settled]
    if len(hit):
        p = _pieces(doc[hit], pos[hit], doc[source], pos[source])
        bucket = int(mix(ids[:1].astype(np.uint64))[0] % np.uint64(buckets))
        yield (bucket, p[0].tobytes(), p[1].astype(np.uint32).tobytes(), p[2].astype(np.uint32).tobytes(), None, None,
               p[3].tobytes(), p[4].astype(np.uint32).tobytes())
    open_ = np.ones(len(at), dtype=bool)
    open_[hit] = False
    doc, pos, win, mini = doc[open_], pos[open_], win[open_], mini[open_]
    if not len(doc):
        return
    head = np.ones(len(doc), dtype=bool)
    head[1:] = (mini[1:] != mini[:-1]) | (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
    begin = np.flatnonzero(head)
    size = np.diff(np.append(begin, len(doc)))
    if size.max() > RUN:                                    # split long runs
        more = -(-size // RUN)
        inner = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        begin = np.repeat(begin, more) + inner * RUN
        size = np.minimum(np.repeat(size, more) - inner * RUN, RUN)
    # minimizers are small numbers: mixed once more they spread over the buckets
    bucket = ((mix(mini[begin]) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    begin, size, bucket = begin[order], size[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    short = win[np.repeat(begin, size) + inner].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT]
    ends = np.cumsum(size)
    for a, b in zip(cut, np.append(cut[1:], len(begin))):
        r = begin[a:b]
        yield (int(bucket[a]), doc[r].tobytes(), pos[r].astype(np.uint32).tobytes(), size[a:b].astype(np.uint8).tobytes(),
               mini[r].astype(np.uint32).tobytes(), short[ends[a] - size[a]:ends[b - 1]].tobytes(), None, None)


def _batch(rows) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names=NAMES)


def _piece_table(parts) -> pa.Table:
    cols = [np.concatenate([np.asarray(p[i], dtype=np.int64) for p in parts] or [np.zeros(0, np.int64)]) for i in range(5)]
    return pa.table([pa.array(c) for c in cols], names=PIECE_NAMES)


def _bucket(table: pa.Table) -> pa.Table:
    """The shared edges of a bucket as pieces; settled pieces pass through."""
    out, runs = [], []
    get = lambda r, c, kind: np.frombuffer(r[c], kind)
    for r in table.to_pylist():
        if r["src_doc"] is not None:
            out.append((get(r, "doc", np.int64), get(r, "pos", np.uint32), get(r, "len", np.uint32),
                        get(r, "src_doc", np.int64), get(r, "src_pos", np.uint32)))
        else:
            runs.append((get(r, "doc", np.int64), get(r, "pos", np.uint32), get(r, "len", np.uint8),
                         get(r, "mini", np.uint32), get(r, "win", np.uint8)))
    if runs:
        doc, pos, size, mini, win = (np.concatenate(c) for c in zip(*runs))
        size = size.astype(np.int64)
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        key = np.zeros((len(inner), 8), dtype=np.uint8)
        key[:, :SHORT] = win.reshape(-1, SHORT)
        # the bucket holds high bits of the mixed minimizer, its own low bits fill the key
        key = key.view("<u8").ravel() | (np.repeat(mini, size).astype(np.uint64) << np.uint64(8 * SHORT))
        doc, pos = np.repeat(doc, size), np.repeat(pos.astype(np.int64), size) + inner
        hit, source = _sources(key, doc, pos)
        copy = doc[hit] != doc[source]
        hit, source = hit[copy], source[copy]
        out.append(_pieces(doc[hit], pos[hit], doc[source], pos[source]))
    return _piece_table(out)


def pieces(rows: DataFrame, buckets: int, bits: int = HASH_BITS) -> DataFrame:
    """Pieces ``(doc, pos, len, src_doc, src_pos)`` of ``(rid, text)`` rows:
    windows that a smaller document holds too, by their source."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch["text"]):
                ids = batch["rid"].slice(a, b - a).to_numpy(zero_copy_only=False)
                packed = list(pack_block(ids, data, offsets, buckets, bits))
                for i in range(0, len(packed), 512):
                    yield _batch(packed[i:i + 512])

    return rows.select("rid", "text").mapInArrow(run, PACKED).groupBy("bucket").applyInArrow(_bucket, PIECES)


def compact(found: DataFrame) -> DataFrame:
    """Joins pieces at joints that do not branch: spans with the same columns.
    ``found`` is a written table."""
    after = found.select(F.col("doc").alias("__doc"), (F.col("pos") + F.col("len")).alias("__at"),
                         F.col("src_doc").alias("__src"), (F.col("src_pos") + F.col("len")).alias("__src_at"))
    joint = ((found["doc"] == after["__doc"]) & (found["pos"] == after["__at"]) & (found["src_doc"] == after["__src"])
             & (found["src_pos"] == after["__src_at"]))
    linked = found.join(after, joint, "left").withColumn("head", F.when(F.col("__doc").isNull(), 1).otherwise(0))
    order = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)     # one document
    path = linked.withColumn("path", F.sum("head").over(order))
    return path.groupBy("doc", "path").agg(
        F.min("pos").alias("pos"), F.sum("len").alias("len"), F.min("src_doc").alias("src_doc"),
        F.min("src_pos").alias("src_pos")).select(*PIECE_NAMES)


OUT = ("rid long, n_words long, n_removed long, kept_sha256 string, kept string, "
       "checks array<struct<src_doc:long,src_pos:long,len:long,digest:binary>>")
CHECK = pa.list_(pa.struct([("src_doc", pa.int64()), ("src_pos", pa.int64()), ("len", pa.int64()), ("digest", pa.binary())]))


def _apply(batches, with_text: bool):
    """Removes each text's spans and digests the spans and sources in it."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = []
            for rid, text, copies, sources in zip(*(part[c].to_pylist() for c in ("rid", "text", "copies", "sources"))):
                words = (text or "").encode().split()          # bytes split at the same six characters
                checks, keep = [], None

                def digest(pos, n, words=words):
                    return hashlib.blake2b(b" ".join(words[pos:pos + n + K - 1]), digest_size=16).digest()

                for s in copies or ():
                    if keep is None:
                        keep = np.ones(len(words), dtype=bool)
                    keep[s["pos"]:s["pos"] + s["len"] + K - 1] = False
                    checks.append((s["src_doc"], s["src_pos"], s["len"], digest(s["pos"], s["len"])))
                checks.extend((rid, s["pos"], s["len"], digest(s["pos"], s["len"])) for s in sources or ())
                kept = words if keep is None else [words[i] for i in np.flatnonzero(keep)]
                joined = b" ".join(kept)
                out.append((rid, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(),
                            joined.decode() if with_text and len(kept) < len(words) else None,
                            [dict(zip(("src_doc", "src_pos", "len", "digest"), c)) for c in checks] or None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), CHECK]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                  names=["rid", "n_words", "n_removed", "kept_sha256", "kept", "checks"])


def _strip(rows: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    copies = spans.groupBy("doc").agg(F.collect_list(F.struct("pos", "len", "src_doc", "src_pos")).alias("copies"))
    # a source is asked for each stretch once, however many copies it has
    sources = spans.select("src_doc", "src_pos", "len").distinct().groupBy("src_doc").agg(
        F.collect_list(F.struct(F.col("src_pos").alias("pos"), "len")).alias("sources"))
    asked = copies.join(sources, copies["doc"] == sources["src_doc"], "full").select(
        F.coalesce("doc", "src_doc").alias("rid"), "copies", "sources")
    full = rows.select("rid", "text").join(asked, "rid", "left").select("rid", "text", "copies", "sources")
    return materialize(full.mapInArrow(lambda b: _apply(b, with_text), OUT), "dedup-out")


def _hashes(rows: DataFrame, stretches: DataFrame, bits: int) -> DataFrame:
    """``key``: the hashes of all windows in stretches (src_doc, src_pos, len)."""
    asked = stretches.groupBy("src_doc").agg(F.collect_list(F.struct("src_pos", "len")).alias("at"))
    texts = rows.join(asked, rows["rid"] == asked["src_doc"]).select("text", "at")

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch["text"]):
                words = Words(data, offsets)
                win, _ = _windows(words, bits)
                found = [_short(win[words.first[i] + s["src_pos"]:words.first[i] + s["src_pos"] + s["len"]])
                         for i, at in enumerate(batch["at"].slice(a, b - a).to_pylist()) for s in at]
                yield pa.record_batch([pa.array(np.unique(np.concatenate(found)).view(np.int64))], names=["key"])

    return texts.mapInArrow(run, "key long").distinct()


def _by_words(rows: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """Repeated windows with one of the hashes ``keys``, told apart by the
    digest of their words, as pieces of one window with their smallest source."""
    passes = max(1, -(-keys.count() // KEYS))
    found = None
    for i in range(passes):
        some = [r["key"] for r in keys.where(F.pmod("key", F.lit(passes)) == i).collect()]
        wanted = rows.sparkSession.sparkContext.broadcast(np.sort(np.array(some, dtype=np.int64).view(np.uint64)))

        def run(batches, wanted=wanted):
            for batch in batches:
                for a, b, data, offsets in text_blocks(batch["text"]):
                    words = Words(data, offsets)
                    win, inside = _windows(words, bits)
                    at = np.flatnonzero(inside)
                    at = at[np.isin(_short(win[at]), wanted.value)]
                    if not len(at):
                        continue
                    raw = data.tobytes()
                    digests = [hashlib.blake2b(b" ".join(raw[words.start[j]:words.end[j]] for j in range(p, p + K)),
                                               digest_size=16).digest() for p in at.tolist()]
                    ids = batch["rid"].slice(a, b - a).to_numpy(zero_copy_only=False)
                    yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(ids[words.doc[at]]), pa.array(words.pos[at])],
                                          names=["digest", "doc", "pos"])

        part = rows.select("rid", "text").mapInArrow(run, "digest binary, doc long, pos long")
        found = part if found is None else found.unionByName(part)
    found = materialize(found, "dedup-windows")
    source = found.groupBy("digest").agg(F.min(F.struct("doc", "pos")).alias("src"), F.max("doc").alias("last")) \
        .filter("last > src.doc").drop("last")
    return found.join(source, "digest").filter("doc > src.doc").select(
        "doc", "pos", F.lit(1).cast("long").alias("len"), F.col("src.doc").alias("src_doc"), F.col("src.pos").alias("src_pos"))


def dedup(rows: DataFrame, with_text: bool = False, bits: int = HASH_BITS) -> tuple[DataFrame, DataFrame]:
    """``(result, spans)`` of ``(rid, text)`` rows; both are written tables.
    ``result``: rid, n_words, n_removed, kept_sha256 and, if asked for, the
    kept text where words were removed; ``spans``: the verified repeated spans (``PIECES``, positions
    and lengths in windows)."""
    buckets = max(1, -(-total_bytes(rows, "text") // (6 * BUCKET)))
    found = materialize(pieces(rows, buckets, bits), "dedup-pieces")
    spans = materialize(compact(found), "dedup-spans")
    out = _strip(rows, spans, with_text)
    place = ["src_doc", "src_pos", "len"]
    wrong = out.select(F.explode("checks").alias("c")).select("c.*").groupBy(*place) \
        .agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi").select(*place)
    wrong = materialize(wrong, "dedup-wrong")
    if wrong.isEmpty():
        return out, spans
    # equal hashes of different words
    keys = materialize(_hashes(rows, wrong, bits), "dedup-keys")
    single = materialize(_by_words(rows, keys, bits), "dedup-single")
    touched = materialize(spans.join(wrong, place, "left_semi").select("doc").union(single.select("doc")).distinct()
                          .select(F.col("doc").alias("rid")), "dedup-touched")
    spans = materialize(spans.join(wrong, place, "left_anti").unionByName(single), "dedup-spans")
    again = _strip(rows.join(touched, "rid", "left_semi"),
                   spans.join(touched, spans["doc"] == touched["rid"], "left_semi"), with_text)
    return materialize(out.join(touched, "rid", "left_anti").unionByName(again), "dedup-out"), spans


def report(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per document."""
    rows = with_row_ids(documents.select("doc_id", "text")).withColumnRenamed("__rid", "rid")
    out, _ = dedup(rows.select("rid", "text"))
    return rows.select("rid", "doc_id").join(out, "rid").select("doc_id", "n_words", "n_removed", "kept_sha256")


def remove(documents: DataFrame) -> DataFrame:
    """The documents with the kept words as text (joined by one space where
    words were removed; other texts stay as they are), same columns."""
    rows = with_row_ids(documents)
    out, _ = dedup(rows.select(F.col("__rid").alias("rid"), "text"), with_text=True)
    kept = out.filter("n_removed > 0").select(F.col("rid").alias("__id"), F.col("kept").alias("__kept"))
    full = rows.join(kept, rows["__rid"] == kept["__id"], "left")
    cols = [F.coalesce("__kept", "text").alias("text") if c == "text" else rows[c] for c in documents.columns]
    return full.select(*cols)
