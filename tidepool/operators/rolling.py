"""Rolling (per-record) keyed aggregation: one output row per input row.

A keyed rolling aggregate emits, for every record, the aggregate of its key
so far.  Fields other than the key and the aggregated one keep the value of
the key's *first* record.  Batch form: skew-safe chunked prefix scans
(``ordered.running``); streaming form: ``streaming.ops``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered


def rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg: str,
            field: str, keep_first: Sequence[str] = (), pos: str | None = "pos",
            out: str | None = None) -> DataFrame:
    """``agg`` in sum/max/min/count of ``field`` per key, after every record.

    Output: keys, ``pos`` (1-based position in the key), ``keep_first`` fields
    taken from the key's first record, and the running aggregate (named
    ``out`` or ``field``).
    """
    out = out or field
    aggs = {"_agg": (agg, field)}
    if pos:
        aggs["_pos"] = ("count", F.lit(1))
    if keep_first:
        aggs["_first"] = ("first", F.struct(*keep_first))
    r = ordered.running(df, keys, order, aggs)
    cols = [F.col(k) for k in keys]
    if pos:
        cols.append(F.col("_pos").alias(pos))
    cols += [F.col(f"_first.{f}").alias(f) for f in keep_first]
    cols.append(F.col("_agg").alias(out))
    return r.select(*cols)


def rolling_sum(df, keys, order, field, keep_first=(), **kw):
    return rolling(df, keys, order, "sum", field, keep_first, **kw)


def rolling_max(df, keys, order, field, keep_first=(), **kw):
    return rolling(df, keys, order, "max", field, keep_first, **kw)


def rolling_min(df, keys, order, field, keep_first=(), **kw):
    return rolling(df, keys, order, "min", field, keep_first, **kw)


def rolling_count(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  out: str = "count") -> DataFrame:
    """Counter per key: 1, 2, 3, ... (all other columns kept)."""
    r = ordered.running(df, keys, order, {out: ("count", F.lit(1))})
    return r


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], field: str,
                   later: Mapping[str, Column], agg: str = "sum") -> DataFrame:
    """A fold whose first record passes through untouched.

    Later records become ``later`` (column -> expression, e.g. fixed values)
    with ``field`` = the running ``agg`` of the key; the state stays under the
    original key.  All input columns are kept in order.
    """
    r = ordered.running(df, keys, order, {"_acc": (agg, field), "_pos": ("count", F.lit(1))})
    first = F.col("_pos") == 1
    cols = []
    for c in df.columns:
        if c == field:
            cols.append(F.when(first, F.col(c)).otherwise(F.col("_acc")).alias(c))
        elif c in later:
            cols.append(F.when(first, F.col(c)).otherwise(later[c].cast(df.schema[c].dataType)).alias(c))
        else:
            cols.append(F.col(c))
    return r.select(*cols, F.col("_pos").alias("pos"))


def rolling_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                     out: str = "distinct_count") -> DataFrame:
    """Running number of distinct ``value`` per key, after every record.

    A record counts 1 when it is the first of its (key, value) in ``order``:
    a running count per (key, value) equal to 1.  The flags then run through
    a prefix sum per key.  Both are chunked scans, so neither a hot key nor a
    hot (key, value) pair becomes one task, and no join is needed.
    """
    firsts = ordered.running(df, list(keys) + [value], order, {"_c": ("count", F.lit(1))})
    flagged = firsts.withColumn("_new", (F.col("_c") == 1).cast("int")).drop("_c")
    r = ordered.running(flagged, keys, order, {out: ("sum", "_new")})
    return r.drop("_new").withColumn(out, F.col(out).cast("bigint"))


def group_aggregate(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Final (batch) grouped aggregate: ``groupBy(keys).agg(...)``."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
