"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import delete_on_exit, ensure_checkpoint_dir, ship_package
from ..sources.tables import table

__all__ = ["WORD", "materialize", "ship_package", "small_join", "table", "total_bytes",
           "with_row_ids", "word_count"]

# fixed value: a word is a run of characters other than ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

BROADCAST_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of words (``WORD``) of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back:
    its lineage is cut, and lost executors do not lose it."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
               limit: int = BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """Null-safe equi-join of ``big`` with a per-key table.

    ``small`` is counted first, unless its number of ``rows`` is known (give a
    written table, so that counting is cheap): up to ``limit`` rows it is
    broadcast, beyond that both sides are shuffled and AQE splits skewed keys.
    Either way the rows are the same.
    """
    renamed = small
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__{k}")
    if (small.limit(limit + 1).count() if rows is None else rows) <= limit:
        renamed = F.broadcast(renamed)
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(renamed[f"__{k}"])
        cond = c if cond is None else cond & c
    return big.join(renamed, cond, how).drop(*[f"__{k}" for k in keys])


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes in a text column, over all rows."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).cast("long")).first()[0]


def with_row_ids(documents: DataFrame) -> DataFrame:
    """Adds ``__rid``, unique and in order of doc_id: the doc_id itself where it
    is unique and not null, else a number in that order."""
    keys = documents.select(F.col("doc_id").cast("long").alias("rid"))
    if keys.groupBy("rid").count().filter("rid is null or count > 1").isEmpty():
        return documents.withColumn("__rid", F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("__place")]
    placed = documents.withColumn("__place", F.monotonically_increasing_id())
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(sorted_.withColumn("__rid", F.monotonically_increasing_id()).drop("__place"), "row-ids")
