"""Per-key state and timer rules in batch form (exact, bounded input).

* ``previous_value``  — value state: the key's previous value (null first)
* ``one_shot_timer``  — a timer at first-record time + delay, once per key
* ``timer_each``      — a timer at record time + delay (one per key and time)
* ``rising_alert``    — value rising for ``delay`` without a drop -> alert

The streaming forms (``transformWithState``) are in ``streaming.rules``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import duration
from ..session import materialize
from . import ordered


def _iv(seconds: float):
    return F.make_dt_interval(secs=F.lit(seconds))


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                   out: str = "previous") -> DataFrame:
    """Every record with the previous value of its key (null for the first)."""
    nb = ordered.neighbours(df, keys, order, {"v": value}, [-1], prefix="_pv")
    return nb.withColumn(out, F.col("_pv-1.v")).drop("_pv-1", "_pv_pos")


def one_shot_timer(df: DataFrame, keys: Sequence[str], order: Sequence[str], time_col: str,
                   delay, bounded: bool = True) -> DataFrame:
    """One timer per key, set by its first record (in ``order``) at its event
    time + ``delay``.  Fires when the stream's watermark reaches it; a bounded
    input ends with every timer fired.  A grouped ``min`` (partial aggregation)."""
    st = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(time_col).alias("_t"))
    first = df.groupBy(*keys).agg(F.min(st).alias("_f"))
    out = first.select(*keys, (F.col("_f._t") + _iv(duration(delay))).alias("fire_time"))
    if not bounded:
        # the stream's watermark = its max event time (one scalar)
        mx = df.agg(F.max(time_col)).first()[0]
        out = out.where(F.col("fire_time") <= F.lit(mx).cast(df.schema[time_col].dataType))
    return out


def timer_each(df: DataFrame, keys: Sequence[str], time_col: str, delay) -> DataFrame:
    """A timer at every record's event time + ``delay``; timers of one key at
    the same time are one timer."""
    return df.select(*keys, (F.col(time_col) + _iv(duration(delay))).alias("fire_time")).distinct()


def _segment_chain(t, v, rising, delay_us: int, end_us):
    """Timer chain of one segment (rows sorted by time): [(due, last value)]."""
    out = []
    n, i = len(t), 0
    while i < n and rising[i]:
        due = t[i] + delay_us
        j = int(np.searchsorted(t, due, side="right"))  # first record after the timer
        if not rising[i:j].all():          # a drop at or before the due time cancels
            break
        if j == n and end_us is not None and due > end_us:
            break                          # unbounded input: not due yet
        out.append((due, v[j - 1]))
        i = j
    return out


def _alerts_in_partition(n_keys: int, delay_us: int, end_us):
    """mapInPandas body: rows clustered by (keys, segment) and sorted; a
    segment cut by a batch border is carried into the next batch."""
    seg_cols = [f"_k{i}" for i in range(n_keys)] + ["_sa", "_sb"]

    def emit(pdf, res):
        if pdf.empty:
            return
        ids = pdf.groupby(seg_cols, sort=False, dropna=False).ngroup().to_numpy()
        cuts = np.flatnonzero(np.diff(ids)) + 1
        starts = np.concatenate([[0], cuts])
        stops = np.concatenate([cuts, [len(pdf)]])
        t = pdf["_t"].to_numpy(dtype="int64")
        v = pdf["_v"].to_numpy(dtype="float64")
        r = pdf["_rise"].to_numpy(dtype=bool)
        for a, b in zip(starts, stops):
            for due, last in _segment_chain(t[a:b], v[a:b], r[a:b], delay_us, end_us):
                res.append((*[pdf[c].iat[a] for c in seg_cols[:n_keys]], due, last))

    def run(batches):
        carry = None
        for b in batches:
            pdf = b if carry is None else pd.concat([carry, b], ignore_index=True)
            if pdf.empty:
                continue
            last = pdf[seg_cols].iloc[-1]
            same = np.ones(len(pdf), dtype=bool)
            for c in seg_cols:
                col = pdf[c]
                same &= (col == last[c]).to_numpy() | (col.isna() & pd.isna(last[c])).to_numpy()
            tail_start = len(pdf) - int(np.argmin(same[::-1])) if not same.all() else 0
            done, carry = pdf.iloc[:tail_start], pdf.iloc[tail_start:]
            res: list = []
            emit(done, res)
            if res:
                yield _frame(res, n_keys)
        if carry is not None:
            res = []
            emit(carry, res)
            if res:
                yield _frame(res, n_keys)
    return run


def _frame(res, n_keys):
    cols = [f"_k{i}" for i in range(n_keys)] + ["_fire", "last_value"]
    df = pd.DataFrame(res, columns=cols)
    df["_fire"] = df["_fire"].astype("int64")
    df["last_value"] = df["last_value"].astype("float64")
    return df


def rising_alert(df: DataFrame, keys: Sequence[str], time_col: str, seq: str, value: str,
                 delay, bounded: bool = True) -> DataFrame:
    """Alert when a key's value keeps rising for ``delay``.

    A record whose value is strictly above the key's previous one (0 before
    the first) starts a timer at its event time + ``delay`` unless one is
    running; a record that is not rising, with event time <= the due time,
    cancels it.  When due, the alert carries the key, the due time and the
    last value seen by then; the first rising record after the due time
    starts the next timer.  Records are taken in (event time, ``seq``) order.

    The rule restarts at every non-rising record and at every gap longer than
    ``delay``, so the input is cut there into independent segments (chunked
    scans).  Segments are hash-partitioned and sorted by Spark; one
    ``mapInPandas`` pass per partition walks each segment's timer chain
    with ``searchsorted`` (no per-group Python call).
    """
    d_us = int(round(duration(delay) * 1e6))
    order = [time_col, seq]
    b = ordered.boundaries(df, keys, order)
    nb = ordered.neighbours(df, keys, order, {"v": value, "t": time_col}, [-1], prefix="_p", bounds=b)
    rise = F.col(value) > F.coalesce(F.col("_p-1.v").cast("double"), F.lit(0.0))
    far = F.col("_p-1").isNull() | (F.col(time_col) > F.col("_p-1.t") + _iv(d_us / 1e6))
    marked = (nb.withColumn("_rise", rise)
              # a new segment starts after a non-rising record or at a long gap
              .withColumn("_cut", F.when(far & rise, 1).otherwise(0))
              .withColumn("_drop", F.when(rise, 0).otherwise(1))
              .drop("_p-1", "_p_pos"))
    seg = ordered.running(marked, keys, order, {"_ndrop": ("sum", "_drop"), "_ncut": ("sum", "_cut")},
                          inclusive=False, bounds=b)
    seg = seg.withColumn("_ncut", F.coalesce("_ncut", F.lit(0)) + F.col("_cut"))
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    g = seg.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                   F.coalesce("_ndrop", F.lit(0)).alias("_sa"), F.col("_ncut").alias("_sb"),
                   us.alias("_t"), F.col(seq).alias("_seq"), F.col(value).cast("double").alias("_v"),
                   "_rise")
    end = None
    if not bounded:
        end = df.agg(F.max(us)).first()[0]
    seg_cols = [f"_k{i}" for i in range(len(keys))] + ["_sa", "_sb"]
    limit = segment_row_limit(df.sparkSession)
    g = materialize(g, "segments")          # read by the size check and the walk
    sizes = g.groupBy(*seg_cols).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= limit:
        res = _alerts_by_segment(g, keys, seg_cols, d_us, end)
    else:
        # segments above the limit take the exact join-based chain walk;
        # the rest stay on the per-partition runner
        big = sizes.where(F.col("_n") > limit).drop("_n")
        cond = [g[c].eqNullSafe(big[c]) for c in seg_cols]
        in_big = g.join(big.withColumn("_big", F.lit(True)), cond, "left").select(g["*"], "_big")
        small = in_big.where(F.col("_big").isNull()).drop("_big")
        large = in_big.where(F.col("_big")).drop("_big")
        res = _alerts_by_segment(small, keys, seg_cols, d_us, end).unionByName(
            _alerts_by_doubling(large, keys, seg_cols, d_us, end))
    fire = F.timestamp_micros("_fire")
    if isinstance(df.schema[time_col].dataType, T.TimestampNTZType):
        fire = fire.cast("timestamp_ntz")
    return res.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)],
                      fire.alias("fire_time"), "last_value")


def segment_row_limit(spark) -> int:
    """Largest segment walked in one task (``spark.tidepool.segmentRowLimit``,
    default one million rows); longer ones use the join-based walk."""
    return int(spark.conf.get("spark.tidepool.segmentRowLimit", "1000000"))


def _alerts_by_segment(g: DataFrame, keys, seg_cols, d_us: int, end) -> DataFrame:
    key_fields = [f for f in g.schema.fields if f.name in seg_cols[:len(keys)]]
    schema = T.StructType(key_fields + [T.StructField("_fire", T.LongType()),
                                        T.StructField("last_value", T.DoubleType())])
    clustered = g.repartition(*seg_cols).sortWithinPartitions(*seg_cols, "_t", "_seq")
    return clustered.mapInPandas(_alerts_in_partition(len(keys), d_us, end), schema)


def _on_ids(a: DataFrame, b: DataFrame, seg_cols, a_id: str, b_id: str) -> DataFrame:
    """Inner join on (segment keys, row id); null keys match null keys."""
    cond = [a[c].eqNullSafe(b[c]) for c in seg_cols] + [a[a_id] == b[b_id]]
    return a.join(b, cond, "inner")


def _alerts_by_doubling(g: DataFrame, keys, seg_cols, d_us: int, end) -> DataFrame:
    """Timer chains of long segments without holding a segment in one task.

    For every row r of a segment (rows rising, except a final non-rising
    terminator): ``nxt(r)`` = first row with t > t(r) + delay and ``last(r)``
    = last row with t <= t(r) + delay, both by chunked as-of scans over the
    rows plus one probe per row.  A timer started at r fires at t(r) + delay
    with last(r)'s value unless last(r) is the terminator (cancelled); the
    next timer starts at nxt(r) if it is rising.  The chain from each
    segment's first row is found by pointer doubling: log2(chain length)
    rounds of equi-joins on row ids, each round written out (lineage cut).
    """
    order = ["_t", "_kind", "_seq"]
    data = g.select(*seg_cols, "_t", "_seq", "_v", "_rise", F.lit(0).alias("_kind"))
    probes = g.select(*seg_cols, (F.col("_t") + d_us).alias("_t"), "_seq",
                      F.lit(None).cast("double").alias("_v"), F.lit(None).cast("boolean").alias("_rise"),
                      F.lit(1).alias("_kind"))
    u = data.unionByName(probes)
    b = ordered.boundaries(u, seg_cols, order)
    payload = {"seq": "_seq", "v": "_v", "rise": "_rise"}
    u = ordered.next_match(u, seg_cols, order, F.col("_kind") == 0, payload, "_nx", bounds=b)
    u = ordered.next_match(u, seg_cols, order, F.col("_kind") == 0, payload, "_ls", bounds=b,
                           previous=True)
    step = u.where(F.col("_kind") == 1).select(
        *seg_cols, F.col("_seq").alias("_id"), (F.col("_t")).alias("_due"),
        F.col("_ls.v").alias("_last"), F.col("_ls.rise").alias("_ok"),
        F.when(F.col("_ls.rise") & F.col("_nx.rise"), F.col("_nx.seq")).alias("_next"),
        F.col("_nx").isNull().alias("_tail"))
    step = materialize(step, "chain-step")
    firsts = g.groupBy(*seg_cols).agg(F.min(F.struct("_t", "_seq"))["_seq"].alias("_id"))
    members = materialize(firsts, "chain-members")
    jump = step.select(*seg_cols, "_id", F.col("_next").alias("_j"))
    # R <- R + J(R); J <- J o J   (after round k, R holds chain steps < 2^(k+1))
    while jump.where(F.col("_j").isNotNull()).limit(1).count() > 0:
        hop = _on_ids(members, jump, seg_cols, "_id", "_id").where(F.col("_j").isNotNull()) \
            .select(*[members[c] for c in seg_cols], F.col("_j").alias("_id"))
        members = materialize(members.unionByName(hop).distinct(), "chain-members")
        j2 = jump.select(*[F.col(c).alias(f"_q{i}") for i, c in enumerate(seg_cols)],
                         F.col("_id").alias("_mid"), F.col("_j").alias("_j2"))
        cond = [jump[c].eqNullSafe(j2[f"_q{i}"]) for i, c in enumerate(seg_cols)]
        jump = materialize(jump.join(j2, cond + [jump["_j"] == j2["_mid"]], "left")
                           .select(*[jump[c] for c in seg_cols], jump["_id"], F.col("_j2").alias("_j")),
                           "chain-jump")
    fired = _on_ids(members, step, seg_cols, "_id", "_id").select(
        *[members[c] for c in seg_cols], "_due", "_last", "_ok", "_tail").where(F.col("_ok"))
    if end is not None:
        fired = fired.where(~F.col("_tail") | (F.col("_due") <= F.lit(end)))
    return fired.select(*seg_cols[:len(keys)], F.col("_due").alias("_fire"),
                        F.col("_last").alias("last_value"))
