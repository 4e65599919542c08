"""Exact dedup with a heavy-hitter split; built-in functions only.

Texts are equal when they are identical after all ASCII white space is
deleted.  Of equal texts the row with the most code points stays, then the
one with the smallest doc_id.

1. *Digests.*  One scan writes a line per row: its number, SHA-256 of the
   normalised text and code points.  Texts are not shuffled.
2. *Frequent digests.*  Misra-Gries summaries of ``COUNTERS`` counters (the
   sketch behind ``approx_top_k``, which drops the median counter instead of
   one) are built per partition, merged in groups and then into one.  Any
   digest above ``2 * 3.5 / COUNTERS`` of the rows comes out.
3. *Verified winners.*  Candidates are counted exactly and their winners
   chosen by a grouped aggregate of their rows (combined before the shuffle).
   At most ``COUNTERS`` candidates exist, so this table is broadcast: rows of
   frequent digests are settled where they lie.
4. *The rest* is grouped by digest through an ordinary shuffle.  Only digests
   found twice or more have a line to join back; AQE may split a skewed side.

Defined cases: null counts as the empty text, and all empty texts are one
group; a null doc_id comes last among ties; of rows that are equal in text and
doc_id one stays; an empty table gives no rows; other columns are carried by
``keep`` and ignored by ``report``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_join, with_row_ids

# fixed value: the white space that does not count
WHITE = " \t\n\x0b\x0c\r"

COUNTERS = 8192                  # size of a summary; also bounds the broadcast table
MERGE_GROUPS = 64                # summaries are merged in so many groups first


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null: empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _digests(documents: DataFrame) -> DataFrame:
    """``rid, doc_id, digest, length`` of documents with row numbers."""
    return documents.select(
        F.col("__rid").alias("rid"), "doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        F.coalesce(F.length("text"), F.lit(0)).alias("length"))


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``item``: 64-bit hashes of digests that a Misra-Gries summary finds
    frequent, at most ``counters`` of them.  Too many do no harm."""
    items = digests.select(F.xxhash64("digest").alias("item"),
                           F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part"))
    state = (items.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(item, {counters})").alias("state"))
             .groupBy(F.lit("all").alias("all")).agg(F.expr(f"approx_top_k_combine(state, {counters})").alias("state")))
    found = F.expr(f"approx_top_k_estimate(state, {counters})")
    return state.select(F.explode(found).alias("found")).select("found.item")


def _winners(digests: DataFrame) -> DataFrame:
    """Per digest: rows, and number and doc_id of the row that stays."""
    rank = F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")
    return (digests.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
            .select("digest", "group_size", F.col("best.rid").alias("keep_rid"), F.col("best.doc_id").alias("keep_id")))


def _split(documents: DataFrame, counters: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The digests, the winners of frequent digests (a table of at most
    ``counters`` lines, but for colliding hashes) and those of other digests
    with two rows or more."""
    digests = materialize(_digests(documents), "exact-digests")
    items = F.broadcast(materialize(frequent(digests, counters), "exact-frequent"))
    is_frequent = F.xxhash64("digest") == F.col("item")
    heavy = materialize(_winners(digests.join(items, is_frequent, "left_semi")).filter("group_size > 1"), "exact-heavy")
    rest = digests.join(items, is_frequent, "left_anti")
    light = materialize(_winners(rest).filter("group_size > 1"), "exact-light")
    return digests, heavy, light


def _settled(rows: DataFrame) -> DataFrame:
    own = F.col("keep_rid").isNull()
    return rows.select("rid", "doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       (own | (F.col("keep_rid") == F.col("rid"))).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def report(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """A row per document: ``rid`` (its row number), ``doc_id``, ``keep_id``
    (of the row that stays), ``group_size``, ``kept`` and ``text_sha256``."""
    digests, heavy, light = _split(with_row_ids(documents), counters)
    here = digests.join(F.broadcast(heavy), "digest", "left")           # settled without a shuffle
    settled = _settled(here.filter("keep_rid is not null"))
    others = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    return settled.unionByName(_settled(small_join(others, light, ["digest"], "left")))


def keep(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns.  Rows of
    frequent digests are dropped where they lie; of the others only the
    numbers of dropped rows are joined with the texts."""
    numbered = with_row_ids(documents.select("doc_id", "text", F.struct("*").alias("whole")))
    digests, heavy, light = _split(numbered, counters)
    stays = F.broadcast(heavy.select(F.col("digest").alias("known"), "keep_rid"))
    own = F.unhex(F.sha2(normalised(F.col("text")), 256)) == F.col("known")
    rows = numbered.join(stays, own, "left").filter("keep_rid is null or keep_rid = __rid")
    gone = materialize(small_join(digests, light, ["digest"]).filter("rid <> keep_rid")
                       .select(F.col("rid").alias("__rid")), "exact-gone")
    return rows.join(gone, "__rid", "left_anti").select("whole.*")
