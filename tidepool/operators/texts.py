"""Running count of every word of a table of texts.

The tokens of a text are already in order, so they are never sorted or
shuffled one by one:

1. ``text_blocks`` cuts the texts, in the order of their ids, into blocks of
   about ``BLOCK_BYTES``: a running sum over the bytes per id.
2. Words are counted per block; a running sum over the blocks of a word says
   how often it occurs before a block.  A very common word has one row per
   block there, and a word's first block needs none.
3. The texts are dealt by block and read in order.  Each word's counter begins
   at what the blocks before have.

Several texts may share an id; their tokens are ordered by line and position,
so these texts are merged.  Ids whose texts pass ``BLOCK_BYTES`` together are
blocks of their own and are numbered by a chunked scan (``ordered.running``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ordered, rolling, transforms

BLOCK_BYTES = 8 << 20
BATCH_TOKENS = 1 << 17


def tokens(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """One row per token: ``keep``, ``line_no``, ``token_pos`` (from 1), ``word``."""
    lines = docs.select(*keep, F.posexplode(F.split(text_col, "\n")).alias("line_no", "value"))
    only_sep = (F.length("value") > 0) & (F.length(F.rtrim("value")) == 0)
    toks = lines.where(~only_sep).select(
        *keep, (F.col("line_no") + 1).cast("bigint").alias("line_no"),
        F.posexplode(transforms.split_tokens(F.col("value"))).alias("token_pos", "word"))
    return toks.withColumn("token_pos", (F.col("token_pos") + 1).cast("bigint"))


def text_blocks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(``docs`` with ``_block`` and ``_alone``, number of blocks that are one
    id with several long texts).

    Blocks rise with the id (null first); ``_alone`` marks the rows of such an id."""
    ids = docs.groupBy(id_col).agg(F.sum(F.octet_length(text_col).cast("bigint") + 1).alias("_bytes"),
                                   F.count(F.lit(1)).alias("_texts"))
    ids = materialize(ids, "text-ids")
    placed = ordered.running(ids, [], [id_col], {"_before": ("sum", "_bytes")}, inclusive=False)
    # an id longer than a block moves the next id into another one
    starts = placed.groupBy(F.floor(F.coalesce("_before", F.lit(0)) / F.lit(BLOCK_BYTES)).alias("_at"),
                            ((F.col("_texts") > 1) & (F.col("_bytes") > BLOCK_BYTES)).alias("_alone")) \
        .agg(F.min(id_col).alias("_start"))
    starts = starts.agg(F.sort_array(F.collect_list(F.struct("_start", "_alone"))).alias("_s"))
    starts = materialize(starts.select(F.transform("_s", lambda s: s["_start"]).alias("_starts"),
                                       F.transform("_s", lambda s: s["_alone"]).alias("_flags")), "text-blocks")
    blocks, alone = starts.select(F.size("_starts"), F.size(F.filter("_flags", lambda f: f))).first()
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, blocks.bit_length())))])
    # number of starts up to the id, the first left out, by halving
    block = F.aggregate(steps, F.lit(0), lambda a, h: F.when(F.get("_starts", a + h) <= F.col(id_col), a + h).otherwise(a))
    if not alone:
        starts = starts.select("_starts")
    out = docs.crossJoin(F.broadcast(starts)).withColumn("_block", block)
    out = out.withColumn("_alone", F.get("_flags", F.col("_block")) if alone else F.lit(False))
    return out.select(*docs.columns, F.col("_block").cast("bigint").alias("_block"), "_alone"), alone


def running_word_count(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """After every token, the running count of its word, tokens in (id, line,
    position) order: ``id_col``, ``line_no``, ``token_pos``, ``word``, ``count``."""
    docs = docs.select(id_col, text_col).where(F.col(text_col).isNotNull())
    placed, alone = text_blocks(docs, id_col, text_col)
    per_block = tokens(placed, ["_block"], text_col).groupBy("_block", "word").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("word").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    carry = per_block.select("_block", "word", before.alias("_before")).where(F.col("_before").isNotNull())
    if alone:
        carry = materialize(carry, "words-before")
    id_type = docs.schema[id_col].dataType
    rows = placed.where(~F.col("_alone")).select("_block", F.lit(None).cast("bigint").alias("_before"), id_col, text_col) \
        .unionAll(carry.select("_block", "_before", F.lit(None).cast(id_type), "word"))
    rows = rows.repartition("_block").sortWithinPartitions("_block", F.col("_before").isNull(), id_col)
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("line_no", T.LongType()),
                           T.StructField("token_pos", T.LongType()), T.StructField("word", T.StringType()),
                           T.StructField("count", T.LongType())])
    out = rows.mapInArrow(number_tokens, schema)
    if not alone:
        return out
    own = rolling.rolling_count(tokens(placed.where("_alone"), [id_col, "_block"], text_col),
                                ["_block", "word"], ["line_no", "token_pos"])
    own = own.join(carry, ["_block", "word"], "left")
    return out.unionAll(own.select(id_col, "line_no", "token_pos", "word",
                                   (F.coalesce("_before", F.lit(0)) + F.col("count")).alias("count")))


def _numbers(words: list[bytes], seen: dict[bytes, int]) -> np.ndarray:
    """The running count of each word; ``seen`` has the counts before and is kept up."""
    out, get = [], seen.get
    for word in words:
        n = seen[word] = get(word, 0) + 1
        out.append(n)
    return np.array(out, np.int64)


class _Runs:
    """Tokens waiting to be written, as runs of tokens of one id and line."""

    def __init__(self, names: list[str]):
        self.names = names
        self.clear()

    def clear(self):
        self.ids, self.words = [], []
        self.at, self.line, self.first, self.size = [], [], [], []

    def start(self, id_: pa.Array):
        self.ids.append(id_)

    def add(self, line: int, first: int, words: list[bytes]):
        self.at.append(len(self.ids) - 1)
        self.line.append(line)
        self.first.append(first)
        self.size.append(len(words))
        self.words += words

    def batch(self, seen: dict[bytes, int]) -> pa.RecordBatch:
        """The waiting tokens; the last id stays, since more of it may follow."""
        size = np.array(self.size)
        ends = np.cumsum(size)
        pos = np.arange(len(self.words)) + np.repeat(np.array(self.first) - (ends - size), size)
        n = _numbers(self.words, seen)
        out = pa.RecordBatch.from_arrays(
            [pa.concat_arrays(self.ids).take(pa.array(np.repeat(np.array(self.at), size))),
             pa.array(np.repeat(np.array(self.line, np.int64), size)), pa.array(pos.astype(np.int64)),
             pa.array(self.words, pa.binary()).view(pa.string()), pa.array(n)], self.names)
        last = self.ids[-1]
        self.clear()
        self.ids.append(last)
        return out


def _lines(text: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The lines of a text that have tokens, as ``tokens`` splits them."""
    for no, line in enumerate(text.split(b"\n"), 1):
        kept = line.rstrip(b" ")
        if kept or not line:
            yield no, kept.split(b" ")


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def number_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, occurrences before, id, text) by block: first each word with
    its occurrences before the block, then the texts by id (no occurrences)."""
    block, seen, runs, group = None, {}, None, []

    def write():
        """The texts of one id: one is read line by line, several are merged."""
        if not group:
            return
        runs.start(group[0][1])
        if len(group) == 1:
            for no, words in _lines(group[0][2]):
                runs.add(no, 1, words)
                if len(runs.words) >= BATCH_TOKENS:
                    yield runs.batch(seen)
        else:
            merged = [(no, pos, w) for _, _, text in group for no, words in _lines(text) for pos, w in enumerate(words, 1)]
            merged.sort(key=lambda t: t[:2])
            for no, pos, w in merged:
                runs.add(no, pos, [w])
        group.clear()
        if len(runs.words) >= BATCH_TOKENS:
            yield runs.batch(seen)

    for batch in batches:
        runs = runs or _Runs([batch.schema.names[2], "line_no", "token_pos", "word", "count"])
        blocks = batch.column(0).to_numpy()
        texts = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        new = np.flatnonzero((blocks[1:] != blocks[:-1]) | (texts[1:] != texts[:-1])) + 1
        for a, b in zip([0, *new], [*new, len(blocks)]):
            if a == b:
                continue
            if blocks[a] != block:
                yield from write()
                if runs.words:
                    yield runs.batch(seen)
                runs.clear()
                block, seen = blocks[a], {}
            values = batch.column(3).slice(a, b - a).cast(pa.binary()).to_pylist()
            if not texts[a]:
                seen.update(zip(values, batch.column(1).slice(a, b - a).to_pylist()))
                continue
            ids = batch.column(2).slice(a, b - a)
            for i, (key, text) in enumerate(zip(ids.to_pylist(), values)):
                if group and not _same(group[0][0], key):
                    yield from write()
                group.append((key, ids.slice(i, 1), text))
    yield from write()
    if runs is not None and runs.words:
        yield runs.batch(seen)
