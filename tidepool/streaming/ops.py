"""Streaming forms of the operators (Structured Streaming).

All take a streaming DataFrame and return one; the watermark is declared on
a TIMESTAMP event-time column (``withWatermark`` rejects TIMESTAMP_NTZ).

* ``windowed_counts``   tumbling / sliding windows, append mode
* ``session_counts``    ``session_window``, append mode
* ``rolling_latest``    keyed rolling aggregate, update mode (latest value per
                        key per micro-batch)
* ``distinct_per_window`` exact distinct users per window (dedup + count)
* ``top_n_windows``     foreachBatch writer: counts per (pane, item), then the
                        top N of each window that the watermark has closed
* ``interval_join``     stream-stream join with a time range and watermarks
* ``late_split``        foreachBatch writer that separates late records
* ``windows_with_lateness`` / ``revisions``  windows that stay open for late
                        records, their result in time and every later one
* ``running_total``     foreachBatch writer: a running sum over all micro-batches
* ``followed_by_any``   every later match within a time, as a self-join
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timecols import duration
from ..operators import ordered, windows
from ..session import delete, delete_on_exit, path_exists
from . import packed_join


def _spec(x) -> str:
    return f"{int(round(duration(x) * 1e6))} microseconds"


def windowed_counts(stream: DataFrame, time_col: str, size, slide=None, keys: Sequence[str] = (),
                    aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Counts (and ``aggs``) per key and window, emitted when the watermark
    closes the window (append mode)."""
    w = F.window(time_col, _spec(size), _spec(slide) if slide else None) if slide else \
        F.window(time_col, _spec(size))
    aggs = aggs or {"count": F.count(F.lit(1))}
    out = stream.groupBy(w.alias("w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *aggs.keys())


def session_counts(stream: DataFrame, time_col: str, gap, keys: Sequence[str],
                   aggs: Mapping[str, Column] | None = None) -> DataFrame:
    aggs = aggs or {"count": F.count(F.lit(1))}
    out = stream.groupBy(F.session_window(time_col, _spec(gap)).alias("s"), *keys).agg(
        *[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("s.start").alias("window_start"), F.col("s.end").alias("window_end"),
                      *aggs.keys())


def rolling_latest(stream: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Keyed running aggregate; run in ``update`` mode, each micro-batch emits
    the new value of every key it touched."""
    return stream.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def distinct_per_window(stream: DataFrame, time_col: str, size, user_col: str,
                        keys: Sequence[str] = (), out: str = "uv") -> DataFrame:
    """Exact distinct ``user_col`` per window: drop duplicate (window, user)
    pairs (state bounded by the watermark), then count."""
    w = F.window(time_col, _spec(size))
    firsts = stream.withColumn("w", w).dropDuplicates(["w", *keys, user_col])
    agg = firsts.groupBy("w", *keys).agg(F.count(F.lit(1)).alias(out))
    return agg.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      out)


def top_n_windows(time_col: str, item_col: str, size, slide, n: int, disorder, count_col: str = "item_count"):
    """``writer`` of the top ``n`` items per sliding window end, for a stream of
    ``time_col`` and ``item_col``: for a folder, a ``foreachBatch`` function.

    A record lies in ``size / slide`` windows, so counts per window would be so
    many rows of state.  What is kept are counts per pane (one slide) and item,
    of the panes that a window still open reaches.  Each micro-batch adds its
    records to them; windows whose end the watermark (newest event time of
    earlier batches less ``disorder``) has newly passed are summed from the panes
    (``windows.sliding``), ranked and written, once.  A late record counts in
    those of its windows that are still open.  A batch that comes again reads the
    panes of the batch before and replaces its own.
    """
    size_us, slide_us = int(round(duration(size) * 1e6)), int(round(duration(slide) * 1e6))
    wait_ms = int(round(duration(disorder) * 1000))

    def writer(path: str):
        panes, marks = (path.rstrip("/") + x for x in ("_panes", "_watermarks"))

        def watermark(spark: SparkSession, batch_id: int) -> int:
            """The watermark in a micro-batch, in microseconds."""
            if not path_exists(spark, marks):
                return 0
            top = spark.read.parquet(marks).where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
            return 0 if top is None else max(0, (top // 1000 - wait_ms) * 1000)

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            before, now = watermark(spark, batch_id - 1), watermark(spark, batch_id)
            us = F.unix_micros(F.col(time_col).cast("timestamp"))
            rows = batch.where(F.col(time_col).isNotNull()).select(
                (us - F.pmod(us, F.lit(slide_us))).alias("pane"), F.col(item_col), us.alias("us"))
            rows = rows.groupBy("pane", item_col).agg(F.count(F.lit(1)).alias("n"), F.max("us").alias("newest"))
            earlier = f"{panes}/batch_id={batch_id - 1}"
            if path_exists(spark, earlier):
                kept = spark.read.parquet(earlier).where(F.col("pane") + F.lit(size_us) > F.lit(before))
                rows = rows.unionByName(kept).groupBy("pane", item_col).agg(F.sum("n").alias("n"), F.max("newest").alias("newest"))
            here = f"{panes}/batch_id={batch_id}"
            rows.write.mode("overwrite").parquet(here)
            rows = spark.read.parquet(here)
            rows.agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")
            counts = windows.sliding(rows.select(F.timestamp_micros("pane").alias("pane"), item_col, "n"), "pane",
                                     size, slide, [item_col], {count_col: ("sum", "n")})
            end = F.unix_micros("window_end")
            closed = counts.where((end > F.lit(before)) & (end <= F.lit(now)))
            top = windows.top_n_per_window(closed, "window_end", count_col, n, [item_col])
            top.select("window_end", item_col, count_col, F.col("rank").cast("bigint").alias("rank")) \
               .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            delete(spark, f"{panes}/batch_id={batch_id - 2}")
            for kept in (panes, marks):
                delete_on_exit(spark, kept)
        return write
    return writer


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str,
                  right_time: str, lower, upper, how: str = "inner", packed: bool = True) -> DataFrame:
    """Stream-stream join on a key and ``left.t + lower <= right.t <= left.t + upper``.

    Both inputs need watermarks; state is dropped once the watermark passes
    the range, so outer rows are emitted then.

    The inner join keeps its state in ``packed_join``, if that carries the
    columns (``packed_join.sides``).  Its columns are found by name, in append
    mode; with ``packed=False`` the result is Spark's join, of whose columns the
    inputs still know and whose watermarks further stateful operators can use."""
    sides = packed_join.sides(left, right, left_key, right_key, left_time, right_time) if packed and how == "inner" else None
    if sides is not None:
        return packed_join.interval_join(left, right, *sides, lower, upper)
    lo = F.make_dt_interval(secs=F.lit(duration(lower)))
    hi = F.make_dt_interval(secs=F.lit(duration(upper)))
    cond = ((left[left_key] == right[right_key]) & (right[right_time] >= left[left_time] + lo)
            & (right[right_time] <= left[left_time] + hi))
    return left.join(right, cond, how)


def late_split(main_path: str, late_path: str, time_col: str, window_col: str, lateness=0, delay=0):
    """A ``foreachBatch`` writer for late data: each micro-batch is split by
    comparing its records' window end + ``lateness`` with the watermark before
    it, the largest event time of earlier batches less the allowed disorder
    ``delay``; late records go to ``late_path``, the rest to ``main_path``.
    The running max is a one-row-per-batch side table
    (``main_path``/_watermarks), so a batch never rescans earlier output.
    Returns the callback."""
    lat = F.make_dt_interval(secs=F.lit(duration(lateness) + duration(delay)))
    marks = main_path.rstrip("/") + "_watermarks"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = None
        if path_exists(spark, marks):               # none before the first batch
            m = spark.read.parquet(marks)
            prev = m.where(F.col("batch_id") < batch_id).agg(F.max("max_ts")).first()[0]
        b = batch.persist()
        late = F.lit(False) if prev is None else (F.col(window_col + ".end") + lat <= F.lit(prev))
        # one folder per micro-batch, overwritten: a retried batch replaces
        # its own output instead of appending it twice
        part = f"batch_id={batch_id}"
        b.where(late).write.mode("overwrite").parquet(f"{late_path}/{part}")
        b.where(~late).write.mode("overwrite").parquet(f"{main_path}/{part}")
        b.agg(F.max(time_col).alias("max_ts")).write.mode("overwrite").parquet(f"{marks}/{part}")
        b.unpersist()
    return write


NEWEST = "_newest"


def windows_with_lateness(stream: DataFrame, time_col: str, size, keys: Sequence[str], aggs: Mapping[str, Column],
                          disorder, lateness) -> DataFrame:
    """Fixed windows that take late records, for ``update`` mode: a window is
    kept for ``disorder + lateness`` after its end, and every micro-batch emits
    the windows that it changed.  ``_newest`` is a window's newest event time;
    ``revisions`` reads the progress of the stream from it."""
    wait = f"{int(round((duration(disorder) + duration(lateness)) * 1000))} milliseconds"
    late = stream.withWatermark(time_col, wait)
    return windowed_counts(late, time_col, size, None, keys, {**aggs, NEWEST: F.max(time_col)})


def revisions(log: DataFrame, keys: Sequence[str], values: Sequence[str], disorder, batch: str = "_batch") -> DataFrame:
    """What the windows of ``windows_with_lateness`` said, and when.

    ``log`` holds the rows of every micro-batch with its id, one folder per
    batch, so a retried batch replaces its own.  A window closes when the
    newest event time of earlier batches is ``disorder`` past its end.  Its last
    result before that is revision 0; each later one, brought by late records,
    is numbered 1, 2, ...  Windows that the log leaves open have revision 0.
    """
    wait = F.make_dt_interval(secs=F.lit(duration(disorder)))
    # one row per micro-batch: the newest event time before it
    marks = log.groupBy(batch).agg(F.max(NEWEST).alias(NEWEST)).select(F.col(batch).alias("_b"), F.max(NEWEST).over(
        Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    rows = log.join(F.broadcast(marks), log[batch] == marks["_b"])
    rows = rows.withColumn("_open", F.col("_before").isNull() | (F.col("_before") - wait < F.col("window_end")))
    each = Window.partitionBy(*keys, "window_start", "_open")
    rows = rows.select("*", F.row_number().over(each.orderBy(F.desc(batch))).alias("_last"),
                       F.row_number().over(each.orderBy(batch)).alias("_nth"))
    return rows.where(~F.col("_open") | (F.col("_last") == 1)).select(
        *keys, "window_start", "window_end", F.when(F.col("_open"), 0).otherwise(F.col("_nth")).alias("revision"), *values)


def newest(log: DataFrame, keys: Sequence[str], values: Sequence[str], batch: str = "_batch") -> DataFrame:
    """The newest result of every window of such a log."""
    best = F.max(F.struct(batch, *values)).alias("_m")
    return log.groupBy(*keys, "window_start", "window_end").agg(best) \
        .select(*keys, "window_start", "window_end", *[F.col(f"_m.{v}").alias(v) for v in values])


def running_total(order: Sequence[str], column: str, out: str):
    """``writer`` of a running sum over the whole stream: for a folder, a
    ``foreachBatch`` function that adds ``out``, the sum of ``column`` over all
    earlier micro-batches and, in ``order``, the records of this one up to each.
    Nothing is kept but a line per batch with its sum; a batch that comes again
    replaces its folder and its line."""
    def writer(path: str):
        sums = path.rstrip("/") + "_sums"

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            before = 0
            if path_exists(spark, sums):
                done = spark.read.parquet(sums).where(F.col("batch_id") < batch_id)
                before = done.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
            rows = batch.persist()
            run = ordered.running(rows, [], order, {out: ("sum", column)})
            run.withColumn(out, (F.col(out) + F.lit(before)).cast("long")) \
               .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            rows.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("total")) \
                .write.mode("overwrite").parquet(f"{sums}/batch_id={batch_id}")
            rows.unpersist()
        return write
    return writer


def followed_by_any(stream: DataFrame, key: str, time_col: str, seq: str, first: Column, second: Column,
                    within) -> DataFrame:
    """``begin(first).followedByAny(second).within(t)``: every ``second`` record
    of a key less than ``within`` after each ``first`` one.  A self-join of the
    stream (with its watermark) on the key and the range of time, so a start
    stays open for all its matches and leaves the state when the watermark is
    ``within`` past it."""
    a = stream.where(first).select(F.col(key).alias("_k"), F.col(time_col).alias("first_time"), F.col(seq).alias("first_id"))
    b = stream.where(second).select(F.col(key), F.col(time_col).alias("second_time"), F.col(seq).alias("second_id"))
    bound = F.make_dt_interval(secs=F.lit(duration(within)))
    later = (F.col("second_time") > F.col("first_time")) | (F.col("second_id") > F.col("first_id"))
    cond = ((F.col("_k") == F.col(key)) & (F.col("second_time") >= F.col("first_time"))
            & (F.col("second_time") < F.col("first_time") + bound) & later)
    return a.join(b, cond).select(key, "first_id", "second_id", "first_time", "second_time")
