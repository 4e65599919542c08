"""Two-stream matching: one-to-one reconciliation and interval joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import duration
from . import ordered


def _epoch_us(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_order: Sequence[str],
              right_order: Sequence[str], left_cols: Sequence[str] = (),
              right_cols: Sequence[str] = ()) -> DataFrame:
    """1:1 consuming match of two streams on ``key``.

    The n-th record of a key on the left pairs with the n-th on the right
    (each side numbered in its own order), so a stored record is used once.
    Output: key, n, ``left`` / ``right`` structs (null when missing) and
    ``status`` in matched / left_only / right_only.  Null keys never match
    and are left out.

    The join key (key, n) is unique on both sides, so a key with many
    records spreads over many join partitions.
    """
    def numbered(df, order, cols, side):
        d = df.where(F.col(key).isNotNull())
        n = ordered.running(d, [key], order, {"_n": ("count", F.lit(1))})
        return n.select(F.col(key).alias(f"_{side}k"), F.col("_n").alias(f"_{side}n"),
                        F.struct(*[F.col(c) for c in cols]).alias(side))

    a = numbered(left, left_order, left_cols or left.columns, "left")
    b = numbered(right, right_order, right_cols or right.columns, "right")
    j = a.join(b, (a["_leftk"] == b["_rightk"]) & (a["_leftn"] == b["_rightn"]), "full_outer")
    status = (F.when(F.col("_leftk").isNull(), F.lit("right_only"))
              .when(F.col("_rightk").isNull(), F.lit("left_only"))
              .otherwise(F.lit("matched")))
    return j.select(F.coalesce("_leftk", "_rightk").alias(key),
                    F.coalesce("_leftn", "_rightn").alias("n"),
                    "left", "right", status.alias("status"))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str,
                  right_time: str, lower, upper, bucket=None, how: str = "inner",
                  right_key: str | None = None) -> DataFrame:
    """Equi key and ``left.t + lower <= right.t <= left.t + upper`` (both ends
    inclusive).

    Time-bucketed: the right side falls in one bucket of width ``bucket``
    (default ``4 * (upper - lower)``); each left record probes the one or two
    buckets its range overlaps.  The join key (key, bucket) spreads one busy key over
    time, so the range filter runs on bounded partitions; AQE splits what is
    still skewed.  Columns of both sides are kept (names must not clash).
    """
    right_key = right_key or key
    lo_s, hi_s = duration(lower), duration(upper)
    if hi_s < lo_s:
        raise ValueError("upper must be >= lower")
    # default width: 4x the range, so about one left row in four probes two
    # buckets while a busy key is still spread over time
    width_us = (int(round(duration(bucket) * 1e6)) if bucket
                else max(int(round(4 * (hi_s - lo_s) * 1e6)), 1))
    lo_us, hi_us = int(round(lo_s * 1e6)), int(round(hi_s * 1e6))
    lt = _epoch_us(left_time)
    lb = left.withColumn("_ib", F.explode(F.sequence(
        F.floor((lt + lo_us) / width_us), F.floor((lt + hi_us) / width_us))))
    rb = right.withColumn("_rb", F.floor(_epoch_us(right_time) / width_us))
    cond = ((lb[key] == rb[right_key]) & (lb["_ib"] == rb["_rb"])
            & (rb[right_time] >= lb[left_time] + F.make_dt_interval(secs=F.lit(lo_s)))
            & (rb[right_time] <= lb[left_time] + F.make_dt_interval(secs=F.lit(hi_s))))
    if how != "inner":
        raise ValueError("batch interval_join is inner; see streaming.ops for outer forms")
    return lb.join(rb, cond, "inner").drop("_ib", "_rb")
