"""Source divergence audit: how the word use of sources differs within a lang.

Terms are runs of letters (ASCII letters, lower-cased, and everything beyond
ASCII).  A lang keeps the terms found in ``MIN_DOCS`` of its documents or
more.

1. *Filter.*  Blocks of documents give the document frequencies of their terms
   (whole terms, compared by bytes); Spark sums them exactly.
2. *Perfect hash.*  The kept terms of each lang are numbered by sharded minimal
   perfect hashes that are built in tasks (``perfect_hash``).
3. *Recount.*  A second pass over the texts looks every occurrence up in the
   broadcast hashes, verifies the stored term and adds to the dense slots of
   the document's (lang, source).  Hashes are broadcast up to
   ``LEXICON_BYTES``; a larger vocabulary takes several passes with some
   shards each.  Slots beyond ``DENSE_SLOTS`` a task are sent on early.
4. *Shares* ``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))`` in whole
   numbers.  Distances of sources are summed over blocks of slots and tiles of
   sources, so no task holds a lang's whole matrix.

Defined cases: null text, lang and source are empty strings; a group without
terms has count 0 for every kept term; a lang without kept terms has distance
0 between all its sources; repeated rows are documents of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import perfect_hash
from .common import materialize, small_join
from .words import Words, text_blocks

MIN_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50

LEXICON_BYTES = 64 << 20         # of perfect hashes in a broadcast
DENSE_SLOTS = 1 << 22            # counters a task holds
BLOCK_SLOTS = 4096               # slots of a distance block
TILE = 128                       # sources of a distance tile

# A-Z lower-cased; other bytes below 0x80 that are no letters become spaces
TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
TERM_BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)
TERM_BYTES[0x80:] = np.arange(0x80, 0x100)


def _known(documents: DataFrame) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def by_value(batch: pa.RecordBatch, column: str):
    """``(value, rows with it)`` of a batch."""
    coded = batch[column].dictionary_encode()
    codes = np.asarray(coded.indices)
    for k, value in enumerate(coded.dictionary.to_pylist()):
        yield value, batch.take(pa.array(np.flatnonzero(codes == k)))


def document_frequencies(documents: DataFrame) -> DataFrame:
    """``lang, word, docs``: in how many documents of its lang a term occurs."""

    def run(batches):
        for batch in batches:
            for lang, rows in by_value(batch, "lang"):
                for _, _, data, offsets in text_blocks(rows["text"]):
                    words = Words(TERM_BYTES[data], offsets)
                    if not len(words.hash):
                        continue
                    number, first = perfect_hash.numbered(words)
                    once = np.unique(words.doc * np.int64(len(first)) + number)
                    docs = np.bincount(once % len(first), minlength=len(first))
                    yield pa.record_batch([pa.array([lang] * len(first)), perfect_hash.strings(words, first), pa.array(docs)],
                                          names=["lang", "word", "docs"])

    parts = documents.select("lang", "text").mapInArrow(run, "lang string, word string, docs long")
    return parts.groupBy("lang", "word").agg(F.sum("docs").alias("docs"))


def _loads(lexicon: DataFrame, limit: int) -> list[list]:
    """The lines of a lexicon in lots of at most ``limit`` bytes (one line at
    least); a line stands for about 65,536 words."""
    spark = lexicon.sparkSession
    sizes = lexicon.select("lang", "shard", perfect_hash.stored_bytes(F.col("n"), F.col("bits"), F.col("keys")).alias("size"))
    lots, filled = [[]], 0
    for r in sizes.orderBy("lang", "shard").collect():
        if filled and filled + r["size"] > limit:
            lots, filled = lots + [[]], 0
        lots[-1].append((r["lang"], r["shard"]))
        filled += r["size"]
    if len(lots) == 1:
        return [None]
    return [spark.createDataFrame(lot, "lang string, shard int") for lot in lots]


def recount(documents: DataFrame, lexicon: DataFrame, limit: int = LEXICON_BYTES, held: int = DENSE_SLOTS) -> DataFrame:
    """``lang, source, slot, count`` of all kept terms that occur."""
    spark = documents.sparkSession
    out = None
    for lot in _loads(lexicon, limit):
        rows = lexicon if lot is None else lexicon.join(F.broadcast(lot), ["lang", "shard"])
        shared = spark.sparkContext.broadcast(perfect_hash.load(rows.collect()))
        part = documents.mapInArrow(_counter(shared, held), "lang string, source string, slot int, count long")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("lang", "source", "slot").agg(F.sum("count").alias("count"))


def _counter(shared, limit: int):
    def run(batches):
        lexicons = shared.value
        dense: dict[tuple, np.ndarray] = {}
        held = 0

        def flush():
            for (lang, source), slots in dense.items():
                at = np.flatnonzero(slots)
                for a in range(0, len(at), 10_000):
                    part = at[a:a + 10_000]
                    yield pa.record_batch([pa.array([lang] * len(part)), pa.array([source] * len(part)),
                                           pa.array(part.astype(np.int32)), pa.array(slots[part])],
                                          names=["lang", "source", "slot", "count"])
            dense.clear()

        for batch in batches:
            for lang, rows in by_value(batch, "lang"):
                lexicon = lexicons.get(lang)
                if lexicon is None:
                    continue
                coded = rows["source"].dictionary_encode()
                codes, names = np.asarray(coded.indices), coded.dictionary.to_pylist()
                width = int(lexicon.number.max()) + 1
                for a, _, data, offsets in text_blocks(rows["text"]):
                    words = Words(TERM_BYTES[data], offsets)
                    slot = lexicon.lookup(words)
                    known = slot >= 0
                    key, count = np.unique(codes[a + words.doc[known]] * np.int64(width) + slot[known], return_counts=True)
                    group = key // width
                    cut = np.flatnonzero(np.diff(group, prepend=-1))
                    for i, j in zip(cut, np.append(cut[1:], len(key))):
                        name = (lang, names[group[i]])
                        if name not in dense:
                            if held + width > limit:
                                yield from flush()
                                held = 0
                            dense[name] = np.zeros(width, dtype=np.int64)
                            held += width
                        dense[name][key[i:j] - group[i] * width] += count[i:j]
        yield from flush()
    return run


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 * (count + PRIOR) / (total + PRIOR * terms))`` by long
    division, three digits at a time: whole numbers below 2^63 throughout, as
    long as the divisor is below 9 * 10^15 words (beyond, the query fails)."""
    divisor = total + F.lit(PRIOR) * terms
    rest, out = count + F.lit(PRIOR), F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * F.lit(1000)
        whole = F.call_function("div", rest, divisor)
        out, rest = out * F.lit(1000) + whole, rest % divisor
    return out + F.lit(1)


def _terms(lexicon: DataFrame) -> DataFrame:
    """``lang, slot, term`` of a lexicon."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                length = np.frombuffer(r["lengths"], dtype=np.int32).astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(length)])
                term = pa.Array.from_buffers(pa.large_string(), len(length),
                                             [None, pa.py_buffer(offsets), pa.py_buffer(r["keys"])]).cast(pa.string())
                slot = pa.array((r["base"] + np.arange(len(length))).astype(np.int32))
                for a in range(0, len(length), 10_000):
                    yield pa.record_batch([pa.array([r["lang"]] * len(slot[a:a + 10_000])), slot[a:a + 10_000], term[a:a + 10_000]],
                                          names=["lang", "slot", "term"])
    return lexicon.select("lang", "base", "keys", "lengths").mapInArrow(run, "lang string, slot int, term string")


def _distances(groups: DataFrame, shares: DataFrame, size: int = TILE, span: int = BLOCK_SLOTS) -> DataFrame:
    """``lang, source, item, value`` of all ordered pairs of sources of a lang:
    the sum over slots of the absolute difference of shares.

    ``groups``: lang, source, place (0, 1, ... in its lang), sources, terms,
    zero (the share of a term that does not occur); ``shares``: lang, place,
    slot, p of those that occur."""
    tiles = F.call_function("div", F.col("sources") - 1, F.lit(size)).cast("int")
    tile = F.call_function("div", F.col("place"), F.lit(size)).cast("int")
    each = groups.select("lang", "place", "zero", "terms", tiles.alias("tiles"), tile.alias("tile"))
    blocks = F.greatest(F.lit(0), F.call_function("div", F.col("terms") - 1, F.lit(span))).cast("int")
    marks = each.withColumn("block", F.explode(F.sequence(F.lit(0), blocks))) \
        .withColumn("slot", F.lit(-1)).withColumn("p", F.col("zero"))
    cells = small_join(shares, each, ["lang", "place"]) \
        .withColumn("block", F.call_function("div", F.col("slot"), F.lit(span)).cast("int"))
    cols = ["lang", "place", "tile", "tiles", "terms", "block", "slot", "p"]
    rows = marks.select(cols).unionByName(cells.select(cols))
    partner = F.explode(F.sequence(F.lit(0), F.col("tiles"))).alias("other")
    rows = rows.select(*cols, partner).select(
        "lang", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "block",
        "place", "terms", "slot", "p")

    def run(table: pa.Table) -> pa.Table:
        col = {c: np.asarray(table[c].combine_chunks()) for c in ("low", "high", "block", "place", "terms", "slot", "p")}
        low, high, block = int(col["low"][0]), int(col["high"][0]), int(col["block"][0])
        width = int(min(span, max(0, col["terms"][0] - block * span)))
        place, line = np.unique(col["place"], return_inverse=True)
        mark = col["slot"] < 0
        zero = np.zeros(len(place), dtype=np.int64)
        zero[line[mark]] = col["p"][mark]
        matrix = np.repeat(zero[:, None], width, axis=1)
        matrix[line[~mark], col["slot"][~mark] - block * span] = col["p"][~mark]
        first = np.flatnonzero(place // size == low)
        second = np.flatnonzero(place // size == high)
        a, b, value = [], [], []
        for i in first:
            js = second[second > i]
            a.append(np.full(len(js), place[i]))
            b.append(place[js])
            value.append(np.abs(matrix[js] - matrix[i]).sum(axis=1))
        lang = table["lang"][0].as_py()
        a, b, value = (np.concatenate(c).astype(np.int64) for c in (a, b, value))
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": value})

    sums = rows.groupBy("lang", "low", "high", "block").applyInArrow(run, "lang string, a long, b long, value long") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("other")),
                                                 F.struct(F.col("b").alias("place"), F.col("a").alias("other")))).alias("x"), "value") \
        .select("lang", "x.place", "x.other", "value")
    name = groups.select("lang", "place", "source")
    item = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"))
    return small_join(small_join(both, name, ["lang", "place"]), item, ["lang", "other"]).select("lang", "source", "item", "value")


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, limit: int = LEXICON_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other
    sources of the lang by distance, part ``term`` the terms that a source uses
    more than its lang does, the first ``top`` of them."""
    docs = _known(documents)
    kept = materialize(document_frequencies(docs).filter(F.col("docs") >= min_docs), "audit-kept")
    lexicon = perfect_hash.build(kept, "audit")
    counts = materialize(recount(docs, lexicon, limit), "audit-counts")

    sizes = lexicon.groupBy("lang").agg(F.sum("n").cast("long").alias("terms"))
    found = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = small_join(docs.groupBy("lang", "source").agg(F.lit(0).alias("none")), found, ["lang", "source"], "left")
    groups = small_join(groups, sizes, ["lang"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"),
        F.sum(F.coalesce("total", F.lit(0))).over(by_lang).alias("lang_total"), F.count("*").over(by_lang).alias("sources"),
        (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("place"))
    zero = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(F.lit(0))
    groups = materialize(groups.withColumn("zero", zero), "audit-groups")

    cells = small_join(counts, groups.select("lang", "source", "place", "total", "lang_total", "terms"), ["lang", "source"])
    cells = cells.withColumn("p", share(F.col("count"), F.col("total"), F.col("terms")))
    pairs = _distances(groups, cells.select("lang", "place", "slot", "p"))

    langs = counts.groupBy("lang", "slot").agg(F.sum("count").alias("lang_count"))
    terms = _terms(lexicon).join(langs, ["lang", "slot"])
    more = cells.join(terms, ["lang", "slot"]) \
        .withColumn("value", F.col("p") - share(F.col("lang_count"), F.col("lang_total"), F.col("terms"))) \
        .filter("value > 0").select("lang", "source", F.col("term").alias("item"), "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def part(rows, name):
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    return part(pairs, "pair").unionByName(part(more, "term").filter(F.col("rank") <= top))
