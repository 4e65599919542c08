"""Event time, watermarks and late data — exact batch semantics.

A bounded-out-of-orderness watermark after a record is ``max(event time so
far) - delay``; the one in force *before* a record excludes it.  A window
``[start, end)`` is due when the watermark reaches ``end - 1 ms`` (its last
timestamp); it stays open ``lateness`` longer, and each record accepted after
it fired fires it again.  A record whose window is past
``end - 1 ms + lateness <= watermark`` is late and goes to a side output.

Everything is computed from the arrival order with chunked prefix scans
(``ordered``), never in one partition.  The streaming engine's own timing
(watermark moves between micro-batches) is covered in ``streaming``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import duration, event_time
from ..session import materialize
from . import ordered

# fixed value: the window's last timestamp is its end minus one millisecond
LAST_TICK_SECONDS = 0.001


def _iv(seconds: float):
    return F.make_dt_interval(secs=F.lit(seconds))


def assign_event_time(df: DataFrame, col: str, unit: str = "s", out: str = "event_time") -> DataFrame:
    """Epoch seconds / millis -> TIMESTAMP column usable by ``withWatermark``."""
    return df.withColumn(out, event_time(col, unit))


def watermark_trace(df: DataFrame, time_col: str, arrival: Sequence[str], delay,
                    bounds: ordered.Bounds | None = None) -> DataFrame:
    """Per record: ``wm_before`` (watermark in force when it arrives, null
    for the first record) and ``wm_after`` (after it), plus ``arrival_pos``.

    The running max over the whole stream is a two-phase prefix max over
    arrival-order chunks — no single-partition window.
    """
    d = duration(delay)
    b = bounds or ordered.boundaries(df, [], arrival)
    aggs = {"_mx": ("max", time_col), "_mxb": ("max", time_col), "arrival_pos": ("count", F.lit(1))}
    r = ordered.running(df, [], arrival, aggs,
                        exclusive=["_mxb"], bounds=b)
    return (r.withColumn("wm_after", F.col("_mx") - _iv(d))
             .withColumn("wm_before", F.col("_mxb") - _iv(d))
             .drop("_mx", "_mxb"))


def _traced_windows(df, time_col, arrival, size, delay, lateness):
    size_s, lat_s = duration(size), duration(lateness)
    t = watermark_trace(df, time_col, arrival, delay)
    w = F.window(time_col, f"{int(size_s * 1e6)} microseconds")
    t = (t.withColumn("window_start", w.start).withColumn("window_end", w.end))
    last_tick = F.col("window_end") - _iv(LAST_TICK_SECONDS)
    late = F.coalesce(last_tick + _iv(lat_s) <= F.col("wm_before"), F.lit(False))
    return t.withColumn("is_late", late)


def late_side_output(df: DataFrame, time_col: str, arrival: Sequence[str], size, delay,
                     lateness=0) -> tuple[DataFrame, DataFrame]:
    """Split records into (accepted, late) for tumbling windows of ``size``.

    Both carry the trace columns and the record's window.
    """
    t = _traced_windows(df, time_col, arrival, size, delay, lateness)
    return t.where(~F.col("is_late")), t.where(F.col("is_late"))


def window_firings(df: DataFrame, time_col: str, arrival: Sequence[str], size, delay,
                   lateness=0, bounded: bool = True) -> DataFrame:
    """Every firing of every tumbling window, with allowed lateness.

    Rows: window_start, window_end, ``kind`` (``on_time``: the watermark
    passed the window; ``late``: an accepted record after that; ``end``: the
    end of a bounded input), ``fire_pos`` (arrival position of the record
    after which it fired; null for ``end``) and ``count`` (accepted records
    of the window so far).  Late records are in ``late_side_output``.
    """
    d = duration(delay)
    # the trace feeds an as-of lookup, two joins and more ordered scans
    # (each may sample its input): write it once as a table instead of
    # recomputing it for every job; this also keeps later plans small
    t = materialize(_traced_windows(df, time_col, arrival, size, delay, lateness), "trace")
    acc = t.where(~F.col("is_late"))
    # first arrival position whose watermark reaches the window's last tick:
    # an as-of lookup done as "next record row" in one ordered union
    due = (acc.select("window_start", "window_end").distinct()
           .select("window_start", "window_end",
                   (F.col("window_end") - _iv(LAST_TICK_SECONDS) + _iv(d)).alias("_v"),
                   F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("_pos")))
    # the running max event time is the watermark after a record plus the delay
    wtype = due.schema["window_start"].dataType
    prog = t.select(F.lit(None).cast(wtype).alias("window_start"),
                    F.lit(None).cast(wtype).alias("window_end"),
                    (F.col("wm_after") + _iv(d)).alias("_v"), F.lit(1).alias("_kind"),
                    F.col("arrival_pos").alias("_pos"))
    u = due.unionByName(prog)
    m = ordered.next_match(u, [], ["_v", "_kind", "_pos"], F.col("_kind") == 1, {"p": "_pos"}, "_fire")
    fire = m.where(F.col("_kind") == 0).select(
        F.col("window_start").alias("_ws"), F.col("_fire.p").alias("fire_pos"))
    j = acc.join(fire, acc["window_start"] == fire["_ws"], "inner").drop("_ws")
    on_time = (j.where(F.col("fire_pos").isNotNull() & (F.col("arrival_pos") <= F.col("fire_pos")))
               .groupBy("window_start", "window_end", "fire_pos").agg(F.count(F.lit(1)).alias("count"))
               .withColumn("kind", F.lit("on_time")))
    after = j.where(F.col("fire_pos").isNotNull())
    # per window in arrival order
    after = ordered.running(after, ["window_start"], ["arrival_pos"], {"count": ("count", F.lit(1))})
    late = (after.where(F.col("arrival_pos") > F.col("fire_pos"))
            .select("window_start", "window_end", F.col("arrival_pos").alias("fire_pos"), "count",
                    F.lit("late").alias("kind")))
    cols = ["window_start", "window_end", "kind", "fire_pos", "count"]
    out = on_time.select(*cols).unionByName(late.select(*cols))
    if bounded:
        end = (j.where(F.col("fire_pos").isNull()).groupBy("window_start", "window_end")
               .agg(F.count(F.lit(1)).alias("count"))
               .select("window_start", "window_end", F.lit("end").alias("kind"),
                       F.lit(None).cast("bigint").alias("fire_pos"), "count"))
        out = out.unionByName(end)
    return out
