"""Skew-safe scans over ordered per-key sequences.

Many operators of this library read a keyed stream "in order": running
aggregates, the previous / next record, the first later record that matches a
condition, count windows, watermark traces.  The direct Spark form is
``Window.partitionBy(keys).orderBy(order)``, which puts every row of a key in
one task.  With one key holding a third of the data that task holds a third
of the data.

Here the keys above ``chunk_rows`` records, and only these, are cut into
*chunks* along the order:

1. ``boundaries`` counts the rows per key (one aggregate, combined on the map
   side).  A key above the limit is cut into as many chunks as its rows ask
   for, between quantiles of the first order column; beyond ``QUANTILES`` chunks
   each range between two quantiles is cut into equal steps.
2. ``_chunk`` is a function of the row and its key's line in that table.  The
   other keys have one chunk each; their plain window is the answer.
3. Each (key, chunk) is scanned locally with a window function.
4. What a chunk needs from the chunks before / after it (a running total,
   a few boundary rows, the first match) is a table with one row per chunk of
   a split key.  It is combined with a window over that table and joined back.

The split depends on the data and ``chunk_rows`` only, not on the cluster or
on estimated sizes.  Running sums of doubles add up in blocks of ``SUM_BLOCK``
records by position, so their rounding does not depend on the chunks either.

Order columns are ascending, and callers pass a total order (ending in a
unique id) so results do not depend on partitioning.  Rows that tie on the
first order column share a chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import chunk_rows, materialize

CHUNK = "_chunk"
QUANTILES = 128
COLD = 256                       # chunk numbers of keys that are not split
BROADCAST_ROWS = 20_000
SUM_BLOCK = 1 << 16

_UNB_PREC = Window.unboundedPreceding


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(df: DataFrame, name: str) -> Column:
    """The first order column as a double that keeps its order."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.StringType):       # the first six bytes as a number
        c = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10)
    return c.cast("double")


class Bounds:
    """How the keys of one (keys, order) layout are split; worked out once and
    reusable by every scan over data with the same key and order columns.

    ``hot`` has one row per split key (``None``: no key is split), with its
    ``_bounds`` (quantiles) and ``_steps``; ``chunks`` bounds the number of
    chunks of split keys, ``longest`` the rows of a key."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], hot: DataFrame | None = None,
                 hot_keys: int = 0, chunks: int = 0, longest: int = 0):
        self.keys, self.order, self.hot = list(keys), list(order), hot
        self.hot_keys, self.chunks, self.longest = hot_keys, chunks, longest

    def _cold(self) -> Column:
        if not self.keys:
            return F.lit(-1).cast("long")
        return (-1 - F.pmod(F.xxhash64(*self.keys), F.lit(COLD))).cast("long")

    def apply(self, df: DataFrame, name: str = CHUNK) -> DataFrame:
        """``df`` with its chunk number: below 0 for keys that are not split."""
        if self.hot is None:
            return df.withColumn(name, self._cold())
        if self.keys:
            hot = self.hot
            for i, k in enumerate(self.keys):
                hot = hot.withColumnRenamed(k, f"_hk{i}")
            if self.hot_keys <= BROADCAST_ROWS:
                hot = F.broadcast(hot)
            cond = F.lit(True)
            for i, k in enumerate(self.keys):
                cond = cond & df[k].eqNullSafe(hot[f"_hk{i}"])
            j = df.join(hot, cond, "left")
        else:                                    # the whole stream is one key: one line
            line = self.hot.first()
            j = df.withColumn("_bounds", F.array(*[F.lit(float(x)) for x in line["_bounds"]]).cast("array<double>")) \
                  .withColumn("_steps", F.lit(line["_steps"]))
        o = _number(df, self.order[0])
        # number of bounds up to o, by halving
        halves = F.array(*[F.lit(1 << i) for i in reversed(range(QUANTILES.bit_length()))])
        at = F.aggregate(halves, F.lit(0), lambda a, h: F.when(F.get("_bounds", a + h - 1) <= o, a + h).otherwise(a))
        lo, hi = F.get("_bounds", at - 1), F.get("_bounds", at)
        step = F.when(hi > lo, F.least(F.floor((o - lo) / (hi - lo) * F.col("_steps")), F.col("_steps") - 1))
        split = at * F.col("_steps") + F.coalesce(step, F.lit(0))
        return j.withColumn(name, F.when(F.col("_bounds").isNull(), self._cold())
                            .otherwise(F.coalesce(split, F.lit(0))).cast("long")) \
                .drop("_bounds", "_steps", *[f"_hk{i}" for i in range(len(self.keys))])


def boundaries(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None,
               rows: int | None = None) -> Bounds:
    """Finds the keys above ``rows`` records (``session.chunk_rows``; with
    ``n``, the n-th part of all rows) and how to split them.

    One job counts rows per key; only if some key is above the limit, a second
    reads the split keys' order column.  Nothing but two numbers is collected.
    """
    counts = df.groupBy(*keys).count()
    total, longest = counts.agg(F.sum("count"), F.max("count")).first()
    total, longest = total or 0, longest or 0
    rows = rows or (max(1, -(-total // n)) if n else chunk_rows(df.sparkSession))
    if longest <= rows:
        return Bounds(keys, order, longest=longest)
    big = materialize(counts.filter(F.col("count") > rows), "hot-keys")
    number = big.count()
    sub = df.select(*keys, _number(df, order[0]).alias("_o"))
    if keys:
        renamed = big
        for i, k in enumerate(keys):
            renamed = renamed.withColumnRenamed(k, f"_hk{i}")
        renamed = F.broadcast(renamed) if number <= BROADCAST_ROWS else renamed
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & sub[k].eqNullSafe(renamed[f"_hk{i}"])
        sub = sub.join(renamed, cond, "left_semi")
    at = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    hot = sub.groupBy(*keys).agg(F.percentile_approx("_o", at, F.lit(10000)).alias("_all"),
                                 F.ceil(F.count(F.lit(1)) / F.lit(float(rows))).cast("long").alias("_parts"))
    # fewer chunks than quantiles: every so many of them, without the two ends
    some = F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.col("_parts"), F.lit(QUANTILES + 1)) - 1, F.lit(1))),
                       lambda i: F.get("_all", F.round(i * F.lit(QUANTILES) / F.col("_parts")).cast("int")))
    few = F.col("_parts") <= QUANTILES
    hot = hot.select(*keys, F.array_distinct(F.coalesce(F.when(few, some).otherwise(F.col("_all")),
                                                        F.array().cast("array<double>"))).alias("_bounds"),
                     F.when(few, F.lit(1)).otherwise(F.ceil(F.col("_parts") / F.lit(QUANTILES))).cast("long").alias("_steps"))
    hot = materialize(hot, "hot-bounds")
    chunks = hot.agg(F.sum(F.col("_steps") * (F.size("_bounds") + 1))).first()[0]
    return Bounds(keys, order, hot, number, chunks, longest)


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            n: int | None = None, bounds: Bounds | None = None,
            chunk: str | None = None) -> DataFrame:
    """Add ``_chunk``: the chunk of its key that a row falls in.

    ``chunk`` names an existing column to use instead; it must not decrease
    along ``order`` within a key (e.g. a chunk id computed for an order the
    current one follows)."""
    return _chunked(df, keys, order, n, bounds, chunk)[0]


def _chunked(df, keys, order, n, bounds, chunk) -> tuple[DataFrame, Bounds | None]:
    """(rows with ``_chunk``, how they were split; None with a given chunk)."""
    if chunk is not None:
        return df.withColumn(CHUNK, F.col(chunk).cast("long")), None
    if bounds is None or bounds.keys != list(keys) or bounds.order != list(order):
        bounds = boundaries(df, keys, order, n)
    return bounds.apply(df), bounds


def _split_only(c: DataFrame, bounds: Bounds | None) -> DataFrame:
    """The rows that take part in the per-chunk tables."""
    return c if bounds is None else c.where(F.col(CHUNK) >= 0)


def _attach(df: DataFrame, table: DataFrame, keys: Sequence[str], bounds: Bounds | None) -> DataFrame:
    """Left-join a per-(key, chunk) table onto rows; null keys match null keys."""
    ren = table
    for i, k in enumerate(keys):
        ren = ren.withColumnRenamed(k, f"_jk{i}")
    ren = ren.withColumnRenamed(CHUNK, "_jc")
    if bounds is not None and bounds.chunks <= BROADCAST_ROWS:
        ren = F.broadcast(ren)
    cond = [df[CHUNK] == ren["_jc"]]
    cond += [df[k].eqNullSafe(ren[f"_jk{i}"]) for i, k in enumerate(keys)]
    out = df.join(ren, on=cond, how="left")
    return out.drop("_jc", *[f"_jk{i}" for i in range(len(keys))])


def _local_window(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def _chunk_window(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK) if keys else Window.orderBy(CHUNK)


# ---------------------------------------------------------------------------
# running aggregates
# ---------------------------------------------------------------------------

# local aggregate, how chunk totals combine, how carry and local combine
_RUNNING = {
    "sum": (F.sum, F.sum, lambda c, l: F.coalesce(c + l, l, c)),
    "count": (F.count, F.sum, lambda c, l: F.coalesce(c, F.lit(0)) + l),
    "max": (F.max, F.max, lambda c, l: F.greatest(c, l)),
    "min": (F.min, F.min, lambda c, l: F.least(c, l)),
    "first": (F.first, F.first, lambda c, l: F.coalesce(c, l)),     # of a struct, which is never null
}


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            aggs: Mapping[str, tuple[str, str | Column]], n: int | None = None,
            inclusive: bool = True, exclusive: Sequence[str] = (),
            bounds: Bounds | None = None, chunk: str | None = None) -> DataFrame:
    """Add one running-aggregate column per ``aggs`` entry.

    ``aggs = {"out": ("sum" | "count" | "max" | "min" | "first", column)}``
    (``first`` of a struct).  The value on a row covers every earlier row of
    its key in ``order`` and, when ``inclusive``, the row itself (names in
    ``exclusive`` never include it).  Equal to
    ``agg(col).over(partitionBy(keys).orderBy(order).rowsBetween(-inf, 0))``.
    """
    c, bounds = _chunked(df, keys, order, n, bounds, chunk)
    blocks = [] if bounds is None or bounds.longest <= SUM_BLOCK else [
        name for name, (f, e) in aggs.items()
        if f == "sum" and isinstance(df.select(_col(e)).schema[0].dataType, (T.DoubleType, T.FloatType))]
    if blocks:
        return _with_block_sums(df, keys, order, aggs, blocks, inclusive, exclusive, bounds)
    w_in = _local_window(keys, order).rowsBetween(_UNB_PREC, Window.currentRow)
    w_ex = _local_window(keys, order).rowsBetween(_UNB_PREC, -1)

    def frame(name):
        return w_ex if (not inclusive or name in exclusive) else w_in

    local = c.select("*", *[
        _RUNNING[f][0](_col(e)).over(frame(name)).alias(f"_l_{name}")
        for name, (f, e) in aggs.items()])
    if bounds is not None and bounds.hot is None:    # no key is split: the local scan is the answer
        return local.select(*df.columns, *[F.col(f"_l_{name}").alias(name) for name in aggs])
    place = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    totals = _split_only(c, bounds).groupBy(*keys, CHUNK).agg(*[
        (F.min_by(_col(e), place) if f == "first" else _RUNNING[f][0](_col(e))).alias(f"_t_{name}")
        for name, (f, e) in aggs.items()])
    wp = _chunk_window(keys).rowsBetween(_UNB_PREC, -1)
    carry = totals.select(*keys, CHUNK, *[
        _RUNNING[f][1](F.col(f"_t_{name}")).over(wp).alias(f"_c_{name}")
        for name, (f, _) in aggs.items()])
    joined = _attach(local, carry, keys, bounds)
    outs = [_RUNNING[f][2](F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name)
            for name, (f, _) in aggs.items()]
    return joined.select(*df.columns, *outs)


def _with_block_sums(df, keys, order, aggs, blocks, inclusive, exclusive, bounds) -> DataFrame:
    """Running sums of doubles with a rounding that only depends on the data:
    sums inside blocks of ``SUM_BLOCK`` records by position, plus the running
    sum of the blocks before (worked out in the same way)."""
    rest = {name: a for name, a in aggs.items() if name not in blocks}
    out = running(df, keys, order, {**rest, "_pos": ("count", F.lit(1))}, bounds=bounds, inclusive=True,
                  exclusive=[*exclusive, *(rest if not inclusive else ())])
    out = out.withColumn("_block", F.floor((F.col("_pos") - 1) / SUM_BLOCK))
    w = Window.partitionBy(*keys, "_block").orderBy("_pos")
    w_in, w_ex = w.rowsBetween(_UNB_PREC, Window.currentRow), w.rowsBetween(_UNB_PREC, -1)
    ex = {name for name in blocks if not inclusive or name in exclusive}
    out = out.select("*", *[F.sum(_col(aggs[b][1])).over(w_in).alias(f"_i_{b}") for b in blocks],
                     *[F.sum(_col(aggs[b][1])).over(w_ex).alias(f"_x_{b}") for b in ex])
    totals = out.groupBy(*keys, "_block").agg(*[F.max_by(F.col(f"_i_{b}"), F.col("_pos")).alias(f"_t_{b}") for b in blocks])
    totals = materialize(totals, "block-sums")
    carry = running(totals, keys, ["_block"], {f"_c_{b}": ("sum", F.col(f"_t_{b}")) for b in blocks}, inclusive=False)
    ren = carry.withColumnRenamed("_block", "_jb")
    for i, k in enumerate(keys):
        ren = ren.withColumnRenamed(k, f"_jk{i}")
    cond = [out["_block"] == ren["_jb"]] + [out[k].eqNullSafe(ren[f"_jk{i}"]) for i, k in enumerate(keys)]
    j = out.join(ren, cond, "left")
    done = {b: F.coalesce(F.col(f"_c_{b}") + F.col(f"_{'x' if b in ex else 'i'}_{b}"),
                          F.col(f"_{'x' if b in ex else 'i'}_{b}"), F.col(f"_c_{b}")) for b in blocks}
    return j.select(*[out[c] for c in df.columns], *[done[name].alias(name) if name in done else F.col(name) for name in aggs])


# ---------------------------------------------------------------------------
# neighbouring rows (lag / lead with a halo across chunk borders)
# ---------------------------------------------------------------------------

def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               fields: Mapping[str, str | Column], offsets: Sequence[int],
               prefix: str = "nb", n: int | None = None,
               bounds: Bounds | None = None) -> DataFrame:
    """Add ``{prefix}{off}`` struct columns: ``fields`` of the row ``off``
    places away in the key's sequence (negative = earlier), null past the ends.

    Rows near a chunk border take their neighbours from the boundary rows of
    adjacent chunks (at most ``max|off|`` chunks away, since a chunk is never
    empty).  Also adds ``{prefix}_pos`` = 1-based position in the key.
    """
    k_lead = max([o for o in offsets if o > 0], default=0)
    k_lag = max([-o for o in offsets if o < 0], default=0)
    c, bounds = _chunked(df, keys, order, n, bounds, None)
    wl = _local_window(keys, order)
    payload = F.struct(*[_col(e).alias(name) for name, e in fields.items()])
    c = c.withColumn("_pl", payload)
    locs = [(F.lead("_pl", off) if off > 0 else F.lag("_pl", -off)).over(wl).alias(f"_loc{off}")
            for off in offsets]
    c = c.select("*", F.row_number().over(wl).alias("_rn"),
                 F.count(F.lit(1)).over(Window.partitionBy(*keys, CHUNK)).cast("int").alias("_cnt"),
                 *locs)
    if bounds.hot is None:   # no key is split: plain lag / lead
        return c.select(*df.columns, *[F.col(f"_loc{off}").alias(f"{prefix}{off}") for off in offsets],
                        F.col("_rn").cast("bigint").alias(f"{prefix}_pos"))
    edge_head = F.col("_rn") <= k_lead
    edge_tail = (F.col("_cnt") - F.col("_rn")) < k_lag
    tbl = (_split_only(c, bounds).where(edge_head | edge_tail)
            .groupBy(*keys, CHUNK)
            .agg(F.sort_array(F.collect_list(F.when(edge_head, F.struct("_rn", "_pl")))).alias("_head"),
                 F.sort_array(F.collect_list(F.when(edge_tail, F.struct("_rn", "_pl")))).alias("_tail"),
                 F.max("_cnt").alias("_size")))
    wp = _chunk_window(keys)
    tbl = tbl.select(
        *keys, CHUNK,
        F.flatten(F.collect_list("_head").over(wp.rowsBetween(1, max(k_lead, 1)))).alias("_after"),
        F.flatten(F.collect_list("_tail").over(wp.rowsBetween(-max(k_lag, 1), -1))).alias("_before"),
        F.coalesce(F.sum("_size").over(wp.rowsBetween(_UNB_PREC, -1)), F.lit(0)).alias("_offset"),
    )
    j = _attach(c, tbl, keys, bounds)
    outs = []
    for off in offsets:
        if off > 0:
            ahead = F.col("_cnt") - F.col("_rn")
            halo = F.when(F.size("_after") >= F.lit(off) - ahead, F.try_element_at("_after", F.lit(off) - ahead)["_pl"])
            val = F.when(ahead >= off, F.col(f"_loc{off}")).otherwise(halo)
        else:
            k = -off
            idx = F.size("_before") + F.col("_rn") - F.lit(k)
            halo = F.when(idx >= 1, F.try_element_at("_before", idx)["_pl"])
            val = F.when(F.col("_rn") > k, F.col(f"_loc{off}")).otherwise(halo)
        outs.append(val.alias(f"{prefix}{off}"))
    outs.append((F.coalesce("_offset", F.lit(0)) + F.col("_rn")).cast("bigint").alias(f"{prefix}_pos"))
    return j.select(*df.columns, *outs)


# ---------------------------------------------------------------------------
# first later / last earlier row satisfying a condition
# ---------------------------------------------------------------------------

def next_match(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               cond: Column, fields: Mapping[str, str | Column], name: str,
               n: int | None = None, previous: bool = False,
               bounds: Bounds | None = None) -> DataFrame:
    """Add ``name``: struct of ``fields`` of the first *later* row of the
    same key with ``cond`` true (``previous=True``: the last *earlier* one).

    Inside a chunk this is ``last(.., ignorenulls)`` over a reversed
    ``rowsBetween(unboundedPreceding, -1)`` frame — linear, unlike the
    forward ``first .. unboundedFollowing`` frame.  Across chunks the first
    (last) match of each chunk is carried in the per-chunk table.
    """
    c, bounds = _chunked(df, keys, order, n, bounds, None)
    ord_fields = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    payload = F.struct(*ord_fields, *[_col(e).alias(k) for k, e in fields.items()])
    cand = F.when(cond, payload)
    if previous:
        wl = _local_window(keys, order).rowsBetween(_UNB_PREC, -1)
        pick, chunk_pick = F.last, F.max
        wp = _chunk_window(keys).rowsBetween(_UNB_PREC, -1)
    else:
        desc = [F.col(o).desc() for o in order]
        wl = Window.partitionBy(*keys, CHUNK).orderBy(*desc).rowsBetween(_UNB_PREC, -1)
        pick, chunk_pick = F.last, F.min
        wp = (Window.partitionBy(*keys) if keys else Window).orderBy(F.col(CHUNK).desc()) \
            .rowsBetween(_UNB_PREC, -1)
    local = c.withColumn("_locm", pick(cand, ignorenulls=True).over(wl))
    if bounds.hot is None:
        res = F.col("_locm")
        keep = F.struct(*[res[k].alias(k) for k in fields])
        return local.select(*df.columns, F.when(res.isNotNull(), keep).alias(name))
    firsts = _split_only(c, bounds).groupBy(*keys, CHUNK).agg(chunk_pick(cand).alias("_edge"))
    carry = firsts.select(*keys, CHUNK, F.last("_edge", ignorenulls=True).over(wp).alias("_carry"))
    j = _attach(local, carry, keys, bounds)
    res = F.coalesce(F.col("_locm"), F.col("_carry"))
    keep = F.struct(*[res[k].alias(k) for k in fields])
    return j.select(*df.columns, F.when(res.isNotNull(), keep).alias(name))
