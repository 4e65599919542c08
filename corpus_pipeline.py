"""The corpus pipeline: ``documents`` through quality rules, n-gram Jaccard
join, substring dedup and source mixing to packed token windows.

Every stage works on all that the one before kept; its result is written as
Parquet and read again.  All but the last return the columns of
``documents``, with ``n_chars`` following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import mixing, ngram_join, packing, quality_rules, substring_dedup
from tidepool.llm.common import materialize, table


def _sized(docs: DataFrame, like: DataFrame) -> DataFrame:
    if "n_chars" not in like.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality_rules.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every group of near copies: five-word
    shingles, a similarity of 80 % or more (``op10`` has its own 4 and 85)."""
    return ngram_join.distinct(docs, n=5, threshold=80)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the words out that an earlier document holds in the same order."""
    return _sized(substring_dedup.remove(docs), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets."""
    return _sized(mixing.mix(docs), docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows; a repeated document is packed as often."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_spans),
    ("source_mix", mix_sources),
    ("packing", pack_windows),
]

# token ids of a vocabulary file and the packing order are not for SQL; the
# pipeline is tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
