"""Time and count windows, per key or over the whole stream, and top-N.

Time windows are epoch aligned and half open, ``[start, end)``.  A sliding
window whose slide divides its size is computed from *panes* (one tumbling
window of the slide): every row is aggregated once into its pane.  The direct
``window(ts, size, slide)`` form copies each input row ``size/slide`` times
before the shuffle (120 copies for 10 min / 5 s).  From the panes two forms
write two rows per pane at most:

* *steps* (counts, sums of whole numbers, distinct counts): a pane adds its
  value where its windows begin and takes it away where they end;
* *blocks* (sums, maxima, minima of any type): a window is the end of one block
  of ``size/slide`` panes and the beginning of the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import duration
from . import ordered

STRETCH = 64                     # window sizes per stretch of a key's time line
COUNT_BLOCK = 1 << 16            # records of a key that a count window task reads, about

# aggregate name -> (partial aggregate, combine of partials)
_DECOMPOSABLE = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "max": (F.max, F.max),
    "min": (F.min, F.min),
}


def _spec(seconds: float) -> str:
    if seconds == int(seconds):
        return f"{int(seconds)} seconds"
    return f"{int(round(seconds * 1_000_000))} microseconds"


def _apply(aggs: Mapping[str, tuple[str, str | Column]]):
    out = []
    for name, (fn, col) in aggs.items():
        c = F.col(col) if isinstance(col, str) else col
        if fn == "count_distinct":
            out.append(F.count_distinct(c).alias(name))
        elif fn == "approx_count_distinct":
            out.append(F.approx_count_distinct(c).alias(name))
        else:
            out.append(getattr(F, fn)(c).alias(name))
    return out


def tumbling(df: DataFrame, time_col: str, size, keys: Sequence[str] = (),
             aggs: Mapping[str, tuple[str, str | Column]] | None = None) -> DataFrame:
    """Fixed windows per key: keys, window_start, window_end, aggregates."""
    aggs = aggs or {"count": ("count", F.lit(1))}
    w = F.window(time_col, _spec(duration(size)))
    return (df.groupBy(w.alias("w"), *keys).agg(*_apply(aggs))
            .select(*keys, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), *aggs.keys()))


def sliding(df: DataFrame, time_col: str, size, slide, keys: Sequence[str] = (),
            aggs: Mapping[str, tuple[str, str | Column]] | None = None,
            panes: bool | None = None) -> DataFrame:
    """Sliding windows per key: keys, window_start, window_end, aggregates.

    Uses slide panes when the slide divides the size and every aggregate is one
    of sum, count, max, min, count_distinct; ``panes=False`` forces the direct
    form.
    """
    aggs = aggs or {"count": ("count", F.lit(1))}
    size_s, slide_s = duration(size), duration(slide)
    ratio = size_s / slide_s
    can = ratio == int(ratio) and all(fn in _DECOMPOSABLE or fn == "count_distinct" for fn, _ in aggs.values())
    if panes is None:
        panes = can
    if panes and not can:
        raise ValueError("pane form needs slide | size and sum/count/max/min/count_distinct aggregates")
    if not panes:
        w = F.window(time_col, _spec(size_s), _spec(slide_s))
        return (df.groupBy(w.alias("w"), *keys).agg(*_apply(aggs))
                .select(*keys, F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), *aggs.keys()))
    k = int(ratio)
    slide_us, size_us = int(round(slide_s * 1e6)), int(round(size_s * 1e6))
    ttype = df.schema[time_col].dataType
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    rows = df.where(F.col(time_col).isNotNull()).select(
        *keys, (us - F.pmod(us, F.lit(slide_us))).alias("_pane"),
        *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, (_, c) in aggs.items()])

    steps = [n for n, (fn, _) in aggs.items() if fn in ("count", "count_distinct") or (
        fn == "sum" and isinstance(rows.schema[n].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)))]
    if any(aggs[n][0] == "count_distinct" for n in steps) or len(steps) == len(aggs):
        out = _by_steps(rows, keys, {n: aggs[n][0] for n in steps}, k, slide_us)
        rest = [n for n in aggs if n not in steps]
        if rest:                                     # the same windows twice: joined side by side
            more = _by_blocks(rows, keys, {n: aggs[n][0] for n in rest}, k, slide_us)
            for i, c in enumerate([*keys, "_ws"]):
                more = more.withColumnRenamed(c, f"_jk{i}")
            cond = [out[c].eqNullSafe(more[f"_jk{i}"]) for i, c in enumerate([*keys, "_ws"])]
            out = out.join(more, cond).drop(*[f"_jk{i}" for i in range(len(keys) + 1)])
    else:
        out = _by_blocks(rows, keys, {n: fn for n, (fn, _) in aggs.items()}, k, slide_us)
    start = F.timestamp_micros("_ws").cast(ttype)
    end = F.timestamp_micros(F.col("_ws") + size_us).cast(ttype)
    return out.select(*keys, start.alias("window_start"), end.alias("window_end"), *aggs.keys())


def _by_blocks(rows: DataFrame, keys, fns: Mapping[str, str], k: int, slide_us: int) -> DataFrame:
    """Sums, counts, maxima and minima of all windows from blocks of ``k``
    panes.  A window that begins ``o`` panes into block ``b`` is the end of
    ``b`` from there and the first ``o`` panes of ``b + 1``.  A pane goes to
    these two groups of windows, each of at most ``2 * k`` rows.  In a group
    both parts change only where a pane lies, so a running aggregate from
    either side gives stretches of equal windows, written out after that."""
    partial = rows.groupBy(*keys, "_pane").agg(*[_DECOMPOSABLE[fn][0](n).alias(n) for n, fn in fns.items()])
    number = F.call_function("div", F.col("_pane"), F.lit(slide_us))          # panes lie on multiples of the slide
    block = F.floor(number / F.lit(k)).cast("long")
    # _o: the first window of the group that is past the pane
    at = (number - block * F.lit(k) + 1).cast("int")
    role = F.explode(F.array(F.struct(block.alias("_block"), F.lit(True).alias("_end")),
                             F.struct((block - 1).alias("_block"), F.lit(False).alias("_end")))).alias("_r")
    two = partial.select(*keys, at.alias("_o"), *fns, role).select(*keys, "_r.*", "_o", *fns)
    sides = []
    for n, fn in fns.items():
        sides += [_DECOMPOSABLE[fn][1](F.when(F.col("_end"), F.col(n))).alias(f"_s_{n}"),
                  _DECOMPOSABLE[fn][1](F.when(~F.col("_end"), F.col(n))).alias(f"_p_{n}")]
    each = two.groupBy(*keys, "_block", "_o").agg(
        F.count(F.when(F.col("_end"), 1)).alias("_s_rows"), F.count(F.when(~F.col("_end"), 1)).alias("_p_rows"), *sides)

    names = {"_rows": "count", **fns}
    up = Window.partitionBy(*keys, "_block").orderBy("_o")
    down = Window.partitionBy(*keys, "_block").orderBy(F.col("_o").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = each.select("*", *[_DECOMPOSABLE[fn][1](f"_s{n if n == '_rows' else '_' + n}").over(down).alias(f"_e_{n}")
                               for n, fn in names.items()])
    scan = ahead.select("*", *[_DECOMPOSABLE[fn][1](f"_p{n if n == '_rows' else '_' + n}").over(
        up.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_b_{n}") for n, fn in names.items()],
        F.coalesce(F.lead("_o").over(up), F.lit(k)).alias("_next"), F.lag("_o").over(up).isNull().alias("_first"))

    def join(fn, a, b):
        if fn in ("max", "min"):
            return (F.greatest if fn == "max" else F.least)(a, b)
        return F.coalesce(a + b, a, b)

    def stretch(lo, hi, values):
        return F.struct(lo.cast("int").alias("_lo"), hi.cast("int").alias("_hi"), *[v.alias(n) for n, v in values.items()])

    # before the first pane of the group: the whole of the group's own block
    whole = {n: join(fn, F.col(f"_s{n if n == '_rows' else '_' + n}"), F.col(f"_e_{n}")) for n, fn in names.items()}
    here = {n: join(fn, F.col(f"_e_{n}"), F.col(f"_b_{n}")) for n, fn in names.items()}
    own = stretch(F.col("_o"), F.least(F.col("_next"), F.lit(k)) - 1, here)
    parts = F.when(F.col("_first"), F.array(stretch(F.lit(0), F.col("_o") - 1, whole), own)).otherwise(F.array(own))
    out = scan.select(*keys, "_block", F.explode(parts).alias("_x")).select(*keys, "_block", "_x.*") \
        .where((F.col("_lo") <= F.col("_hi")) & (F.col("_rows") > 0))
    begin = F.col("_block") * F.lit(k * slide_us)
    slide = F.lit(slide_us)
    return out.select(*keys, *fns, F.explode(F.sequence(begin + F.col("_lo") * slide, begin + F.col("_hi") * slide, slide)).alias("_ws"))


def _by_steps(rows: DataFrame, keys, fns: Mapping[str, str], k: int, slide_us: int) -> DataFrame:
    """Counts, sums of whole numbers and distinct counts of all windows as
    steps: a pane adds its value to the window that ends with it and takes it
    away ``k`` windows later.  A pane of a distinct value adds only the windows
    that the value's pane before does not cover, so windows count it once.

    One exchange moves two rows per pane; running sums over a key's steps give
    the values between two steps, which are written out per window only after
    that.  A key's time line is cut into stretches so that it is not one task;
    a stretch begins with the sum of the panes that reach into it."""
    stretch = STRETCH * k * slide_us
    plain = {n: fn for n, fn in fns.items() if fn != "count_distinct"}
    # per column: its change, and for sums whether there is a value at all
    columns = ["_rows", *fns, *[f"_some_{n}" for n, fn in plain.items() if fn == "sum"]]

    def steps(panes: DataFrame, first, values: Mapping[str, Column]) -> DataFrame:
        """The steps of panes whose windows are ``first`` .. ``_pane``."""
        after = F.col("_pane") + F.lit(slide_us)

        def part(us):
            return F.floor(us / F.lit(stretch))

        def step(at, of, sign):
            return F.struct(part(of).alias("_part"), at.alias("_ws"), *[
                (values[c] * F.lit(sign) if c in values else F.lit(0)).cast("long").alias(c) for c in columns])

        last = F.col("_pane")
        border = part(last) * F.lit(stretch)          # a pane's windows lie in one stretch or two
        made = F.when(part(first) < part(last), F.array(step(first, first, 1), step(border, first, -1),
                                                        step(border, last, 1), step(after, last, -1))) \
            .otherwise(F.array(step(first, last, 1), step(after, last, -1)))
        return panes.select(*keys, F.explode(made).alias("s")).select(*keys, "s.*")

    partial = rows.groupBy(*keys, "_pane").agg(
        F.count(F.lit(1)).alias("_rows"), *[_DECOMPOSABLE[fn][0](n).alias(n) for n, fn in plain.items()],
        *[F.count(n).alias(f"_some_{n}") for n, fn in plain.items() if fn == "sum"])
    own = {c: F.coalesce(F.col(c), F.lit(0)) for c in columns if c not in fns or c in plain}
    back = F.lit((k - 1) * slide_us)
    all_ = steps(partial, F.col("_pane") - back, own)
    for n, fn in fns.items():
        if fn == "count_distinct":
            seen = rows.where(F.col(n).isNotNull()).select(*keys, F.col(n).alias("_value"), "_pane").distinct()
            seen = ordered.neighbours(seen, [*keys, "_value"], ["_pane"], {"at": "_pane"}, [-1], prefix="_before")
            first = F.greatest(F.col("_pane") - back, F.col("_before-1.at") + F.lit(slide_us))
            all_ = all_.unionByName(steps(seen, first, {n: F.lit(1)}))

    summed = all_.groupBy(*keys, "_part", "_ws").agg(*[F.sum(c).alias(c) for c in columns])
    w = Window.partitionBy(*keys, "_part").orderBy("_ws")
    run = summed.select(*keys, "_ws", *[F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in columns],
                        F.lead("_ws").over(w).alias("_next"))
    run = run.where((F.col("_rows") > 0) & F.col("_next").isNotNull())
    values = [F.when(F.col(f"_some_{n}") > 0, F.col(n)).alias(n) if plain.get(n) == "sum" else F.col(n) for n in fns]
    return run.select(*keys, *values, F.explode(F.sequence(
        F.col("_ws"), F.col("_next") - slide_us, F.lit(slide_us))).alias("_ws"))


def session(df: DataFrame, time_col: str, gap, keys: Sequence[str], seq: str,
            aggs: Mapping[str, tuple[str, str | Column]] | None = None) -> DataFrame:
    """Gap-based sessions per key.

    A record more than ``gap`` after the previous record of its key starts a
    new session (records exactly ``gap`` apart share one).  The session's
    window is ``[first, last + gap)``.  Built as gaps-and-islands on chunked
    scans, so one busy key does not become one task.
    """
    aggs = aggs or {"count": ("count", F.lit(1))}
    gap_s = duration(gap)
    order = [time_col, seq]
    b = ordered.boundaries(df, keys, order)
    nb = ordered.neighbours(df, keys, order, {"t": time_col}, [-1], prefix="_p", bounds=b)
    start = (F.col("_p-1").isNull()
             | (F.col(time_col) > F.col("_p-1.t") + F.make_dt_interval(secs=F.lit(gap_s))))
    flagged = nb.withColumn("_start", start.cast("int")).drop("_p-1", "_p_pos")
    sid = ordered.running(flagged, keys, order, {"_sid": ("sum", "_start")}, bounds=b)
    out = sid.groupBy(*keys, "_sid").agg(
        F.min(time_col).alias("window_start"),
        (F.max(time_col) + F.make_dt_interval(secs=F.lit(gap_s))).alias("window_end"),
        *_apply(aggs))
    return out.drop("_sid")


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                 slide: int | None = None, value: str | Column | None = None,
                 out: str = "sum", agg: str = "sum") -> DataFrame:
    """Count windows: per key, every ``slide`` records, ``agg`` (sum, count,
    max, min, avg) of ``value`` over the last ``size`` records (fewer at the
    start).  An incomplete tail never fires; ``slide=None`` is the tumbling
    form (slide = size).

    Output: keys, ``pos`` of the firing record, ``n`` records covered, ``out``.
    Positions come from a chunked running count.  The records are then dealt
    in blocks of positions, each with the ``size - 1`` records before it, and a
    frame of ``size`` rows runs inside a block: every window aggregates its own
    records only (nulls, NaN and infinities stay in the windows that hold
    them), and no key is one task.
    """
    slide = slide or size
    value = F.lit(1) if value is None else (F.col(value) if isinstance(value, str) else value)
    r = ordered.running(df.withColumn("_v", value), keys, order, {"pos": ("count", F.lit(1))})
    block = max(COUNT_BLOCK, 4 * size)
    own = F.floor((F.col("pos") - 1) / block)
    # the last size - 1 records of a block are also read by the next one
    halo = F.pmod(F.col("pos") - 1, F.lit(block)) >= block - (size - 1)
    r = r.select(*keys, "pos", "_v", own.alias("_own"), F.explode(
        F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))).alias("_block"))
    w = Window.partitionBy(*keys, "_block").orderBy("pos").rowsBetween(-(size - 1), Window.currentRow)
    r = r.withColumn(out, getattr(F, agg)("_v").over(w))
    fired = r.where((F.col("_own") == F.col("_block")) & (F.col("pos") % slide == 0))
    return fired.select(*keys, "pos", F.least(F.col("pos"), F.lit(size).cast("long")).alias("n"), out)


def top_n_per_window(df: DataFrame, window_col: str, score: str, n: int,
                     tie: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows per window by ``score`` descending, ties by ``tie``
    ascending.  A window with fewer rows returns what it has.

    ``row_number() <= n`` lets Catalyst insert a partial group limit before
    the shuffle, so at most ``n`` rows per window and map task move.
    """
    w = Window.partitionBy(window_col).orderBy(F.col(score).desc(), *[F.col(t) for t in tie])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def window_with_end(df: DataFrame, keys: Sequence[str], time_col: str, size, slide=None,
                    aggs: Mapping[str, tuple[str, str | Column]] | None = None) -> DataFrame:
    """Incremental aggregate per (key, window), tagged with the window end."""
    if slide is None or duration(slide) == duration(size):
        return tumbling(df, time_col, size, keys, aggs).drop("window_start")
    return sliding(df, time_col, size, slide, keys, aggs).drop("window_start")
