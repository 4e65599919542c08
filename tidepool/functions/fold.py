"""User reduces that respect the order of records.

A ``Fold`` lifts a record to a state and combines two neighbouring states, the
earlier one first.  ``combine`` is associative; it need not be commutative, and
nothing built in has to express it (for sums, extrema and the like use the
built-in aggregates).

``rolling_fold`` gives the state after every record, ``window_reduce`` the
state of every time window.  Both read sorted Arrow batches and keep one state
per group; records of a large key or window are folded in pieces, and pieces
are only combined with their neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..operators import ordered
from ..session import materialize
from .timecols import duration


class Fold:
    """``state_schema`` (columns of a state), ``columns`` (what ``lift`` reads,
    in order) and two methods.  States are tuples."""

    state_schema: str = ""
    columns: Sequence[str] = ()

    def lift(self, row: tuple) -> tuple:
        raise NotImplementedError

    def combine(self, earlier: tuple, later: tuple) -> tuple:
        raise NotImplementedError


def _state_type(fold: Fold) -> T.StructType:
    return T._parse_datatype_string(fold.state_schema)


def _structs(states: list[tuple], kind: T.StructType) -> pa.Array:
    columns = list(zip(*states)) if states else [[] for _ in kind]
    arrays = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, kind)]
    return pa.StructArray.from_arrays(arrays, names=kind.fieldNames())


def _lifted(batch: pa.RecordBatch, fold: Fold) -> list[tuple]:
    columns = [batch[c].to_pylist() for c in fold.columns]
    return [fold.lift(r) for r in (zip(*columns) if columns else [()] * batch.num_rows)]


def _states(batch: pa.RecordBatch, column: str) -> list[tuple | None]:
    return [None if r is None else tuple(r.values()) for r in batch[column].to_pylist()]


def _key(batch: pa.RecordBatch, names: Sequence[str], row: int) -> tuple:
    values = (batch[n][row].as_py() for n in names)
    return tuple("NaN" if v != v else v for v in values)      # a NaN equals itself here


def _starts(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Rows at which a group of equal ``names`` begins."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for n in names:
        codes = np.asarray(batch[n].dictionary_encode(null_encoding="encode").indices)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _runs(batches, names: Sequence[str], fold: Fold, states_of: Callable) -> Iterator[tuple]:
    """``(first rows, last rows, states)`` of the groups of sorted batches, a
    group going on from batch to batch as one state."""
    pending = None
    for batch in batches:
        if not batch.num_rows:
            continue
        states, starts = states_of(batch), _starts(batch, names)
        ends = np.append(starts[1:], batch.num_rows)
        done = []
        for i, j in zip(starts, ends):
            acc = states[i]
            for s in states[i + 1:j]:
                acc = fold.combine(acc, s)
            done.append(acc)
        firsts, lasts = batch.take(pa.array(starts)), batch.take(pa.array(ends - 1))
        if pending is not None:
            if pending[3] == _key(batch, names, 0):
                done[0] = fold.combine(pending[2][0], done[0])
                firsts = pa.concat_batches([pending[0], firsts.slice(1)])
            else:
                yield pending[:3]
        m = len(done) - 1
        if m:
            yield firsts.slice(0, m), lasts.slice(0, m), done[:m]
        keep = pa.array([m])
        pending = (firsts.take(keep), lasts.take(keep), done[m:], _key(batch, names, batch.num_rows - 1))
    if pending is not None:
        yield pending[:3]


def rolling_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold,
                 bounds: ordered.Bounds | None = None) -> DataFrame:
    """Every record with the state of its key so far, itself included: the
    columns of ``df`` and those of the state.

    A prefix scan in two passes.  Each (key, chunk) of ``ordered`` is scanned in
    order; only keys above the row limit have several chunks.  For those the
    chunks' last states give what each chunk carries over from the ones before,
    and a second pass combines it with their rows.
    """
    kind = _state_type(fold)
    chunk = ordered.CHUNK
    bounds = bounds or ordered.boundaries(df, keys, order)
    names = [*keys, chunk]
    rows = bounds.apply(df).repartition(*names).sortWithinPartitions(*names, *order)
    schema = T.StructType([*rows.schema.fields, T.StructField("_state", kind)])

    def scan(batches):
        last, acc = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            states, starts = _lifted(batch, fold), set(_starts(batch, names).tolist())
            if last is not None and last == _key(batch, names, 0):
                starts.discard(0)
            for i, s in enumerate(states):
                acc = states[i] = s if i in starts else fold.combine(acc, s)
            last = _key(batch, names, batch.num_rows - 1)
            yield pa.record_batch([*batch.columns, _structs(states, kind)], names=schema.fieldNames())

    scanned = rows.mapInArrow(scan, schema)
    done = [*df.columns, *[F.col(f"_state.{f}").alias(f) for f in kind.fieldNames()]]
    if bounds.hot is None:
        return scanned.select(*done)

    scanned = materialize(scanned, "fold-scan")
    split = scanned.where(F.col(chunk) >= 0)
    totals = split.groupBy(*names).agg(F.max_by("_state", F.struct(*order)).alias("_state"))
    carry_schema = T.StructType([*totals.schema.fields[:-1], T.StructField("_carry", kind)])

    def carried(batches):
        """Per key the state of all chunks before each chunk."""
        last, acc = None, None
        for batch in batches:
            out = []
            for i, s in enumerate(_states(batch, "_state")):
                key = _key(batch, keys, i)
                acc = acc if key == last else None
                out.append(acc)
                acc, last = s if acc is None else fold.combine(acc, s), key
            some = [i for i, s in enumerate(out) if s is not None]
            kept = batch.take(pa.array(some, pa.int64()))
            yield pa.record_batch([*kept.columns[:-1], _structs([out[i] for i in some], kind)], names=carry_schema.fieldNames())

    # one line per chunk of a split key
    lined = totals.repartition(*keys) if keys else totals.coalesce(1)
    carry = lined.sortWithinPartitions(*names).mapInArrow(carried, carry_schema)
    joined = ordered._attach(split, materialize(carry, "fold-carry"), keys, bounds)
    columns = scanned.columns

    def finish(batches):
        for batch in batches:
            states = [s if c is None else fold.combine(c, s)
                      for c, s in zip(_states(batch, "_carry"), _states(batch, "_state"))]
            yield pa.record_batch([*batch.columns[:len(columns) - 1], _structs(states, kind)], names=columns)

    rest = scanned.where(F.col(chunk) < 0)
    return joined.select(*columns, "_carry").mapInArrow(finish, schema).unionByName(rest).select(*done)


def window_reduce(df: DataFrame, time_col: str, size, keys: Sequence[str], order: Sequence[str], fold: Fold) -> DataFrame:
    """Fixed windows reduced in order: keys, window_start, window_end and the
    columns of the state.

    Each input partition folds its own records of a window, in order, and sends
    the state with the range of ``order`` (a total order) that it covers.  Where
    the ranges of a window do not overlap, its states are combined in their
    order.  Only windows whose ranges overlap are read again: their records are
    dealt by ranges of (window, order), so ranges are disjoint and a large
    window is many tasks.
    """
    kind = _state_type(fold)
    size_us = int(round(duration(size) * 1e6))
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    ttype = df.schema[time_col].dataType
    rows = df.where(F.col(time_col).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (us - F.pmod(us, F.lit(size_us))).alias("_w"),
        F.struct(*order).alias("_at"), F.struct(*(fold.columns or order)).alias("_in"))
    group = [*[f"_k{i}" for i in range(len(keys))], "_w"]
    group_fields = [rows.schema[g] for g in group]
    place = rows.schema["_at"].dataType
    part_schema = T.StructType([*group_fields, T.StructField("_lo", place), T.StructField("_hi", place),
                                T.StructField("_state", kind)])
    out_schema = T.StructType([*group_fields, T.StructField("_state", kind)])

    def lift(batch):
        inputs = [tuple(r.values()) for r in batch["_in"].to_pylist()]
        return [fold.lift(r if fold.columns else ()) for r in inputs]

    def pieces(batches):
        for first, last, states in _runs(batches, group, fold, lift):
            yield pa.record_batch([*[first[g] for g in group], first["_at"], last["_at"], _structs(states, kind)],
                                  names=part_schema.fieldNames())

    def merge(batches):
        for first, _, states in _runs(batches, group, fold, lambda b: _states(b, "_state")):
            yield pa.record_batch([*[first[g] for g in group], _structs(states, kind)], names=out_schema.fieldNames())

    parts = materialize(rows.sortWithinPartitions(*group, "_at").mapInArrow(pieces, part_schema), "window-parts")
    before = Window.partitionBy(*group).orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    crossed = materialize(parts.withColumn("_before", F.max("_hi").over(before)).where(F.col("_before") > F.col("_lo"))
                          .select(*[F.col(g).alias(f"_x{i}") for i, g in enumerate(group)]).distinct(), "window-crossed")
    if not crossed.isEmpty():
        def cond(side):
            out = F.lit(True)
            for i, g in enumerate(group):
                out = out & side[g].eqNullSafe(crossed[f"_x{i}"])
            return out
        again = rows.join(crossed, cond(rows), "left_semi").repartitionByRange(*group, "_at") \
            .sortWithinPartitions(*group, "_at").mapInArrow(pieces, part_schema)
        parts = parts.join(crossed, cond(parts), "left_anti").unionByName(again)
    out = parts.repartition(*group).sortWithinPartitions(*group, "_lo").mapInArrow(merge, out_schema)
    start = F.timestamp_micros("_w").cast(ttype)
    end = F.timestamp_micros(F.col("_w") + size_us).cast(ttype)
    return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], start.alias("window_start"),
                      end.alias("window_end"), "_state.*")
