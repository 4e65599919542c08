"""Interval join of two streams whose state is packed per bucket of keys.

Spark's own stream-stream join keeps four state stores per partition and every
waiting record as rows of its own in them, which it puts, counts and scans one by
one.  Here both streams are dealt to buckets of keys (``rules.with_buckets``) and
one call takes a bucket's records of a micro-batch: it matches them with each
other and with the bucket's waiting records, whose columns lie compressed in one
row of state.  Late records are dropped, and waiting ones leave, by the same
watermark as in Spark's join.

Values pass through Python as whole numbers, doubles, text or bytes, beside a bit
per column that tells nulls, and are cast back after it, so they stay exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timecols import duration
from .rules import BUCKET, KEY, with_buckets

DELAY = "spark.watermarkDelayMs"   # Spark's mark on a column with a watermark
RIGHT, US, NULLS = "_right", "_us", "_nulls"
BUCKETS = 512                      # groups that the keys are dealt to
MOST_COLUMNS = 62                  # bits of NULLS
SLICE = 100_000                    # matches that are made at a time
EMPTY = {"long": 0, "double": 0.0, "string": "", "binary": b""}


class Carried(NamedTuple):
    """A column of a stream, the kind of value that carries it, and its field."""
    name: str
    type: T.DataType
    kind: str
    field: str


class Side(NamedTuple):
    key: Carried
    time: Carried
    rest: list[Carried]

    @property
    def fields(self) -> list[str]:
        return [KEY, US, NULLS, *[c.field for c in self.rest]]


def _kind(t: T.DataType) -> str | None:
    if isinstance(t, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "long"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(t, T.DecimalType) or t == T.StringType():
        return "string"
    return "binary" if isinstance(t, T.BinaryType) else None


def _side(stream: DataFrame, key: str, time_col: str) -> Side | None:
    """How the columns of a stream are carried; None if they cannot be."""
    fields = {f.name: f for f in stream.schema.fields}
    if not stream.isStreaming or len({c.lower() for c in fields}) < len(stream.columns) or len(fields) > MOST_COLUMNS \
            or key not in fields or time_col not in fields or key == time_col or DELAY not in fields[time_col].metadata:
        return None
    k, used, rest = fields[key].dataType, {}, []
    if not (isinstance(k, T.IntegralType) or k == T.StringType()):
        return None
    for name, f in fields.items():
        if name in (key, time_col):
            continue
        kind = _kind(f.dataType)
        if kind is None:
            return None
        used[kind] = used.get(kind, -1) + 1
        rest.append(Carried(name, f.dataType, kind, f"_{kind}{used[kind]}"))
    return Side(Carried(key, k, _kind(k), KEY), Carried(time_col, fields[time_col].dataType, "long", US), rest)


def sides(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str,
          right_time: str) -> tuple[Side, Side] | None:
    """How both streams are carried; None where Spark's own join is needed: for
    other than two streams with watermarks, keys other than whole numbers or
    text, nested columns, names on both sides, and time zones other than UTC (in
    which a day may have 23 hours)."""
    a, b = _side(left, left_key, left_time), _side(right, right_key, right_time)
    if a is None or b is None or a.key.kind != b.key.kind \
            or {c.lower() for c in left.columns} & {c.lower() for c in right.columns} \
            or left.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        return None
    return a, b


def _put(c: Carried) -> Column:
    col = F.col(f"`{c.name}`")
    if isinstance(c.type, T.DateType):
        col = F.unix_date(col)
    elif isinstance(c.type, (T.TimestampType, T.TimestampNTZType)):
        col = F.unix_micros(col.cast("timestamp"))
    return col.cast("long" if c.kind == "long" else c.kind)


def _get(c: Carried, value: Column) -> Column:
    if isinstance(c.type, T.DateType):
        return F.date_from_unix_date(value.cast("int"))
    if isinstance(c.type, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(value).cast(c.type)
    if c.kind == "double":             # pandas takes NaN for null
        value = F.coalesce(value, F.lit(float("nan")))
    return value.cast(c.type)


def _records(stream: DataFrame, side: Side, right: bool, slots: dict[str, str]) -> DataFrame:
    """The records of one stream in the form that both share.  Its event time is
    a whole number that keeps Spark's mark, by which late records are dropped."""
    mark = {DELAY: stream.schema[side.time.name].metadata[DELAY]}
    nulls = F.lit(0).cast("long")
    for i, c in enumerate(side.rest):
        nulls = nulls + F.when(F.col(f"`{c.name}`").isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    own = {c.field: F.coalesce(_put(c), F.lit(EMPTY[c.kind]).cast(c.kind)) for c in side.rest}
    have = stream.where(F.col(f"`{side.key.name}`").isNotNull() & F.col(f"`{side.time.name}`").isNotNull())
    rows = have.select(_put(side.key).alias(KEY), _put(side.time).alias(US, metadata=mark), nulls.alias(NULLS),
                       F.lit(right).alias(RIGHT),
                       *[own.get(f, F.lit(EMPTY[kind]).cast(kind)).alias(f) for f, kind in slots.items()])
    return with_buckets(rows, [KEY], BUCKETS)


def matches(lk: np.ndarray, lt: np.ndarray, rk: np.ndarray, rt: np.ndarray, lo: int,
            hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the left and right records of all pairs with ``lk = rk`` and
    ``lt + lo <= rt <= lt + hi``, at most ``SLICE`` at a time.  Keys are codes
    from 0 on."""
    if not (len(lk) and len(rk)):
        return
    on_left, on_right = (np.bincount(k, minlength=max(lk.max(), rk.max()) + 1) > 0 for k in (lk, rk))
    left, right = np.flatnonzero(on_right[lk]), np.flatnonzero(on_left[rk])
    if not len(left):
        return
    # right records by (key, time) as one rising number, the time as its rank
    right = right[np.lexsort((rt[right], rk[right]))]
    times = np.unique(rt[right])
    width = len(times) + 1
    at = rk[right] * width + np.searchsorted(times, rt[right])
    start, t = lk[left] * width, lt[left]
    first = np.searchsorted(at, start + np.searchsorted(times, t + lo))
    last = np.searchsorted(at, start + np.searchsorted(times, t + hi, "right"))
    n = np.maximum(last - first, 0)
    ends = np.cumsum(n)
    for p in range(0, int(ends[-1]), SLICE):
        q = np.arange(p, min(p + SLICE, int(ends[-1])))
        i = np.searchsorted(ends, q, "right")
        yield left[i], right[first[i] + q - (ends[i] - n[i])]


def _load(state: GroupState) -> list | None:
    if not state.exists:
        return None
    size, packed = state.get
    return pickle.loads(pa.decompress(packed, size, codec="zstd", asbytes=True))


def _store(state: GroupState, waiting: list) -> None:
    raw = pickle.dumps(waiting, pickle.HIGHEST_PROTOCOL)
    state.update((len(raw), pa.compress(raw, codec="zstd", asbytes=True)))


def interval_join(left: DataFrame, right: DataFrame, a: Side, b: Side, lower, upper) -> DataFrame:
    """Inner join of two streams that are carried as ``a`` and ``b``."""
    lo, hi = int(round(duration(lower) * 1e6)), int(round(duration(upper) * 1e6))
    slots = {c.field: c.kind for c in [*a.rest, *b.rest]}
    both = _records(left, a, False, slots).unionByName(_records(right, b, True, slots))
    fields = a.fields, b.fields
    made = [f"_l{f}" for f in a.fields], [f"_r{f}" for f in b.fields]
    kinds = {KEY: a.key.kind, US: "long", NULLS: "long", **slots}
    out = ", ".join(f"{n} {kinds[f]}" for names, own in zip(made, fields) for n, f in zip(names, own))

    def step(_, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:          # all that waits has left the range
            state.remove()
            return
        mark = state.getCurrentWatermarkMs() * 1000
        parts: tuple[list, list] = ([], [])
        for p in pdfs:
            is_right = p[RIGHT].to_numpy(dtype=bool)
            for rows, own, here in zip(parts, fields, (~is_right, is_right)):
                rows.append([p[f].to_numpy()[here] for f in own])
        old = _load(state)
        had = [0, 0] if old is None else [len(old[0][0]), len(old[1][0])]
        rows = [[np.concatenate(c) for c in zip(*([old[s]] if old else []), *parts[s])] for s in (0, 1)]
        (lk, lt, *_), (rk, rt, *_) = rows
        codes = pd.factorize(np.concatenate([lk, rk]))[0]
        lk, rk = codes[:len(lk)], codes[len(lk):]
        # new left records with all right ones, waiting left ones with new right ones
        for i0, i1, j0 in ((had[0], len(lk), 0), (0, had[0], had[1])):
            for i, j in matches(lk[i0:i1], lt[i0:i1], rk[j0:], rt[j0:], lo, hi):
                yield pd.DataFrame({n: c[x] for names, cols, x in zip(made, rows, (i + i0, j + j0))
                                    for n, c in zip(names, cols)})
        # a later record is newer than the watermark; these may still meet one
        due = lt + hi, rt - lo
        kept = [[c[d > mark] for c in cols] for cols, d in zip(rows, due)]
        last = max((int(d.max()) for d in due if len(d)), default=mark)
        if last > mark:
            _store(state, kept)
            state.setTimeoutTimestamp(-(-last // 1000))
        elif state.exists:
            state.remove()

    found = both.groupBy(BUCKET).applyInPandasWithState(
        step, out, "size long, waiting binary", "append", GroupStateTimeout.EventTimeTimeout)
    cols = []
    for stream, side, p in ((left, a, "_l"), (right, b, "_r")):
        known = {side.key.name: _get(side.key, F.col(p + KEY)), side.time.name: _get(side.time, F.col(p + US))}
        for i, c in enumerate(side.rest):
            null = F.col(p + NULLS).bitwiseAND(F.lit(1 << i).cast("long")) != 0
            known[c.name] = F.when(null, F.lit(None).cast(c.type)).otherwise(_get(c, F.col(p + c.field)))
        cols += [known[n].alias(n) for n in stream.columns]
    return found.select(*cols)
