"""Stateful per-key rules on streams (``applyInPandasWithState``).

A call of Python per key and micro-batch costs far more than the few records
that it brings, so the rules are grouped by buckets of keys (``_by_bucket``): one
call takes a bucket's records in (key, time, sequence) order and its state, which
holds an entry per key, and steps through the keys.  The bucket's timeout is
the earliest of its keys; keys whose time has come fire with it.

``rising_alert_stream`` keeps per key: the previous value, the running
timer's due time and the last value; it fires a timer either when a later
record of the key arrives (in event-time order inside the micro-batch) or
through the event-time timeout once the watermark passes the due time.
``previous_value_stream`` keeps the previous value per key.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timecols import duration

BUCKETS = 1024                     # groups that the keys of a stream are dealt to
KEY, NO_KEY, BUCKET = "_key", "_no_key", "_bucket"

_ALERT_OUT = "key string, fire_time timestamp, last_value double"


def with_buckets(stream: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The stream with the bucket of its keys."""
    return stream.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _in_order(pdfs: Iterator[pd.DataFrame], time_col: str, seq: str, value: str):
    """Records of a micro-batch by (time, seq), as three arrays.  The Arrow
    batches are reduced to these columns one by one."""
    parts = [(p[time_col].astype("datetime64[us]").astype("int64").to_numpy(), p[seq].to_numpy(), p[value].to_numpy())
             for p in pdfs]
    t, s, v = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((s, t))
    return t[order], s[order], v[order]


def split_keys(codes: np.ndarray):
    """First and last row (exclusive) of every run of equal ``codes``."""
    at = np.flatnonzero(np.diff(codes)) + 1
    return zip(np.concatenate([[0], at]).tolist(), np.concatenate([at, [len(codes)]]).tolist())


def factorize(column: pd.Series, missing: pd.Series | None = None):
    """Codes of a column's values and the values; null has the code -1."""
    codes, values = pd.factorize(column)
    if missing is not None:
        codes = np.where(missing.to_numpy(dtype=bool), -1, codes)
    return codes, values.tolist()


def _keys_in_order(pdfs: Iterator[pd.DataFrame], time_col: str, seq: str, value: str):
    """``key, times, seqs, values`` of every key of a bucket, each by (time, seq)."""
    parts = [(p[KEY], p[NO_KEY], p[time_col].astype("datetime64[us]").astype("int64").to_numpy(), p[seq].to_numpy(),
              p[value].to_numpy()) for p in pdfs]
    codes, names = factorize(pd.concat([p[0] for p in parts], ignore_index=True), pd.concat([p[1] for p in parts]))
    t, s, v = (np.concatenate(c) for c in list(zip(*parts))[2:])
    order = np.lexsort((s, t, codes))
    codes, t, s, v = codes[order], t[order], s[order], v[order]
    for a, b in split_keys(codes):
        yield names[codes[a]] if codes[a] >= 0 else None, t[a:b], s[a:b], v[a:b]


def _keyed(stream: DataFrame, key: str) -> DataFrame:
    """The stream with its bucket, and its key apart from whether there is one:
    a null would turn a column of whole numbers into floats in pandas."""
    c = F.col(key)
    if isinstance(stream.schema[key].dataType, T.NumericType):
        c = F.coalesce(c, F.lit(0).cast(stream.schema[key].dataType))
    return with_buckets(stream.withColumn(KEY, c).withColumn(NO_KEY, F.col(key).isNull()), [key])


def _frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    """Rows as a frame in which whole numbers stay whole beside nulls."""
    cols = {}
    for f, vals in zip(schema.fields, zip(*rows)):
        cols[f.name] = pd.array(vals, dtype="Int64") if isinstance(f.dataType, T.LongType) else list(vals)
    return pd.DataFrame(cols)


def _by_bucket(stream: DataFrame, key: str, time_col: str, seq: str, value: str, out: str,
               records: Callable, expired: Callable | None = None) -> DataFrame:
    """Runs a rule per key over buckets of keys.

    ``records(key, state, times, seqs, values, mark)`` takes a key's records of
    the micro-batch, its state (None at first) and the watermark in milliseconds;
    it returns the new state (None: nothing is kept), the time in milliseconds at
    which the key wants to be woken (or None) and its output rows.  ``expired(key,
    state, mark)`` is called once the watermark has passed that time, for keys
    without records in the micro-batch, and returns the same.
    """
    cols = list(dict.fromkeys([time_col, seq, value]))
    keyed = _keyed(stream, key).select(BUCKET, KEY, NO_KEY, *cols)
    schema = T.StructType.fromDDL(out) if isinstance(out, str) else out

    def step(_, pdfs, state: GroupState) -> Iterator[pd.DataFrame]:
        kept = pickle.loads(state.get[0]) if state.exists else {}
        mark = state.getCurrentWatermarkMs() if expired is not None else None
        rows: list[tuple] = []
        seen = set()

        def put(k, new, wake, made):
            rows.extend(made)
            if new is None:
                kept.pop(k, None)
            else:
                kept[k] = (wake, new)

        if not state.hasTimedOut:
            for k, t, s, v in _keys_in_order(pdfs, time_col, seq, value):
                seen.add(k)
                put(k, *records(k, kept[k][1] if k in kept else None, t, s, v, mark))
        if expired is not None:
            for k in [k for k, (wake, _) in kept.items() if wake is not None and wake < mark and k not in seen]:
                put(k, *expired(k, kept[k][1], mark))
        if kept:
            state.update((pickle.dumps(kept, pickle.HIGHEST_PROTOCOL),))
            wake = min((w for w, _ in kept.values() if w is not None), default=None)
            if wake is not None:
                state.setTimeoutTimestamp(max(wake, mark))
        elif state.exists:
            state.remove()
        if rows:
            yield _frame(rows, schema)

    timeout = GroupStateTimeout.NoTimeout if expired is None else GroupStateTimeout.EventTimeTimeout
    return keyed.groupBy(BUCKET).applyInPandasWithState(step, out, "keys binary", "append", timeout)


def _wake(due_us: int, mark: int) -> int | None:
    """When a key is woken for a due time; None if the watermark has already
    passed it, as after a late record that was still accepted."""
    return None if due_us // 1000 <= mark else due_us // 1000


def rising_alert_stream(stream: DataFrame, key: str, time_col: str, seq: str, value: str,
                        delay) -> DataFrame:
    """Streaming twin of ``operators.alerts.rising_alert`` (output mode
    append; needs a watermark on ``time_col``).  A timer whose due time the
    watermark has passed fires at once."""
    d_us = int(round(duration(delay) * 1e6))

    def records(k, state, ts, _, vals, mark):
        prev, due, last = state or (0.0, -1, 0.0)
        out = []
        for t, v in zip(ts.tolist(), vals.astype("float64").tolist()):
            if due >= 0 and due < t:               # timer due before this record
                out.append((k, pd.Timestamp(due, unit="us"), last))
                due = -1
            if v > prev:
                if due < 0:
                    due = t + d_us
            else:
                due = -1
            prev = last = v
        wake = _wake(due, mark) if due >= 0 else None
        if due >= 0 and wake is None:
            out.append((k, pd.Timestamp(due, unit="us"), last))
            due = -1
        return (prev, due, last), wake, out

    def expired(k, state, mark):
        prev, due, last = state
        return (prev, -1, last), None, [(k, pd.Timestamp(due, unit="us"), last)] if due >= 0 else []

    keyed = stream.withColumn("key", stream[key].cast("string"))
    return _by_bucket(keyed, "key", time_col, seq, value, _ALERT_OUT, records, expired)


def previous_value_stream(stream: DataFrame, key: str, time_col: str, seq: str, value: str,
                          out_schema: str) -> DataFrame:
    """Every record with its key's previous value (value state, append mode)."""
    names = [c.split()[0] for c in out_schema.split(",")]
    keyed = _keyed(stream, key)
    numeric = isinstance(stream.schema[key].dataType, T.IntegralType)

    def step(_, pdfs, state: GroupState):
        kept = pickle.loads(state.get[0]) if state.exists else {}
        pdf = pd.concat(list(pdfs), ignore_index=True)
        pdf["_code"], keys = factorize(pdf[KEY], pdf[NO_KEY])
        pdf = pdf.sort_values(["_code", time_col, seq], ignore_index=True)
        codes, vals = pdf["_code"].to_numpy(), pdf[value].tolist()
        prevs = [None, *vals[:-1]]
        for a, b in split_keys(codes):
            k = keys[codes[a]] if codes[a] >= 0 else None
            prevs[a] = kept.get(k)
            kept[k] = vals[b - 1]
        state.update((pickle.dumps(kept, pickle.HIGHEST_PROTOCOL),))
        if numeric:
            pdf[key] = pdf[KEY].astype("Int64").mask(pdf[NO_KEY])
        pdf = pdf.assign(previous=pd.Series(prevs, dtype="object"))
        yield pdf[names]

    return keyed.groupBy(BUCKET).applyInPandasWithState(
        step, out_schema, "keys binary", "append", GroupStateTimeout.NoTimeout)


_PAIR_OUT = "user_id long, first_id long, second_id long, first_us long, second_us long, kind string"


def followed_by_within_stream(stream: DataFrame, key: str, time_col: str, seq: str, kind_col: str,
                              first: str, second: str, within) -> DataFrame:
    """``begin(first).followedBy(second).within(t)`` on a stream.

    Per key, starts wait in state (ids and event times); a ``second`` record
    matches every waiting start less than ``within`` before it (its first
    later ``second``) and clears them; starts older than ``within`` time out.
    An event-time timer at the oldest start + ``within`` emits timeouts once
    the watermark passes it.  Output rows: kind ``match`` or ``timeout``.
    """
    w_us = int(round(duration(within) * 1e6))

    def walk(k, state, recs, mark):
        ids, tus = state or ([], [])
        out, head = [], 0                       # waiting starts are ordered by time: a prefix expires

        def expire(now_us):
            """Starts whose deadline (start + within) is at or before now."""
            nonlocal head
            while head < len(ids) and now_us - tus[head] >= w_us:
                out.append((k, ids[head], None, tus[head], None, "timeout"))
                head += 1

        for t, rid, kind in recs:
            expire(t)                           # too old for this or any later record
            if kind == second:
                # a record that came late only matches the starts before it
                keep = bisect_right(tus, t, head)
                out.extend((k, ids[i], int(rid), tus[i], t, "match") for i in range(head, keep))
                ids, tus, head = ids[keep:], tus[keep:], 0
            if kind == first:
                at = bisect_right(tus, t, head)
                ids.insert(at, int(rid))
                tus.insert(at, t)
        expire(mark * 1000)                     # deadlines the watermark passed
        ids, tus = ids[head:], tus[head:]
        if not ids:
            return None, None, out
        return (ids, tus), _wake((tus[0] // 1000 + w_us // 1000 + 1) * 1000, mark), out

    def records(k, state, ts, ids, kinds, mark):
        return walk(k, state, zip(ts.tolist(), ids.tolist(), kinds.tolist()), mark)

    def expired(k, state, mark):
        return walk(k, state, (), mark)

    return _by_bucket(stream, key, time_col, seq, kind_col, _PAIR_OUT, records, expired)


_TIMER_OUT = "user_id long, fire_us long"


def one_shot_timer_stream(stream: DataFrame, key: str, time_col: str, seq: str, delay) -> DataFrame:
    """One event-time timer per key at its first record's time + ``delay``
    (earliest in (time, seq) order within the first micro-batch that has the
    key); it fires once, when the watermark passes it."""
    d_us = int(round(duration(delay) * 1e6))

    def records(k, due, ts, _, __, mark):
        if due is False:                        # it has fired
            return False, None, []
        if due is None:
            due = int(ts[0]) + d_us
        wake = _wake((due // 1000 + 1) * 1000, mark)
        return (due, wake, []) if wake is not None else (False, None, [(k, due)])

    def expired(k, due, mark):
        return False, None, [(k, due)]

    return _by_bucket(stream, key, time_col, seq, seq, _TIMER_OUT, records, expired)


_NEXT_OUT = "user_id long, first_id long, second_id long, first_us long, second_us long"


def next_within_stream(stream: DataFrame, key: str, time_col: str, seq: str, flag: str, within) -> DataFrame:
    """``begin(flag).next(flag).within(t)`` on a stream: a flagged record whose
    next record of the key is flagged too, less than ``within`` later.

    The order inside a key is (time, seq), so records wait in state until the
    watermark passes them (a record that comes late but accepted still takes
    its place); the last passed record is kept for the next one.
    """
    w_us = int(round(duration(within) * 1e6))

    def walk(k, state, new, mark):
        waiting, last = state or ([], None)
        if new:
            waiting = sorted([*waiting, *new])
        passed = bisect_right(waiting, (mark * 1000, 1 << 62, True))
        out = []
        for rec in waiting[:passed]:
            if last is not None and last[2] and rec[2] and rec[0] - last[0] < w_us:
                out.append((k, last[1], rec[1], last[0], rec[0]))
            last = rec
        waiting = waiting[passed:]
        wake = _wake((waiting[0][0] // 1000 + 1) * 1000, mark) if waiting else None
        return (waiting, last), wake, out

    def records(k, state, ts, ids, flags, mark):
        return walk(k, state, [(t, int(i), bool(f)) for t, i, f in zip(ts.tolist(), ids.tolist(), flags.tolist())], mark)

    def expired(k, state, mark):
        return walk(k, state, [], mark)

    return _by_bucket(stream, key, time_col, seq, flag, _NEXT_OUT, records, expired)


_MATCH_OUT = "key long, n long, left_id long, right_id long, status string"


def reconcile_stream(stream: DataFrame, key: str, side: str, time_col: str, seq: str, patience) -> DataFrame:
    """1:1 consuming match of two streams in one (``side`` is ``left`` or
    ``right``): the n-th record of a key on either side pairs with the n-th on
    the other, whichever comes first.  The waiting records are the state; they
    leave as ``left_only`` / ``right_only`` once the watermark is ``patience``
    past the key's newest record."""
    p_us = int(round(duration(patience) * 1e6))

    # state of a key: n, newest and, while records wait, (n, newest, left, right)
    def give_up(k, n, left, right):
        out = [(k, n + i + 1, r, None, "left_only") for i, r in enumerate(left)]
        return out + [(k, n + i + 1, None, r, "right_only") for i, r in enumerate(right)]

    def records(k, state, ts, ids, sides, mark):
        n, newest, left, right = (*(state or (0, 0)), [], [])[:4]
        left, right = list(left), list(right)
        for i, x in zip(ids.tolist(), sides.tolist()):
            if x == "left":
                left.append(i)
            elif x == "right":
                right.append(i)
        newest = max(newest, int(ts[-1]))
        pairs = min(len(left), len(right))
        out = [(k, n + i + 1, left[i], right[i], "matched") for i in range(pairs)]
        n, left, right = n + pairs, left[pairs:], right[pairs:]
        if not left and not right:
            return (n, newest), None, out
        wake = _wake(newest + p_us, mark)
        if wake is None:
            return (n + len(left) + len(right), newest), None, out + give_up(k, n, left, right)
        return (n, newest, left, right), wake, out

    def expired(k, state, mark):
        n, newest, left, right = state
        return (n + len(left) + len(right), newest), None, give_up(k, n, left, right)

    return _by_bucket(stream, key, time_col, seq, side, _MATCH_OUT, records, expired)


_ROLLING_OUT = "key long, pos long, first_id long, id long, agg long"


def rolling_stream(stream: DataFrame, key: str, time_col: str, seq: str, value: str, agg: str = "sum") -> DataFrame:
    """Rolling ``sum``, ``max`` or ``min`` per record on a stream: one output
    row per input row, with the key's first record (its ``seq``).  Records
    count in the order of micro-batches, by (time, seq) inside one."""
    fold = {"sum": np.cumsum, "max": np.maximum.accumulate, "min": np.minimum.accumulate}[agg]
    join = {"sum": lambda a, b: a + b, "max": np.maximum, "min": np.minimum}[agg]

    def records(k, state, _, ids, vals, __):
        run = fold(vals.astype("int64"))
        n, first, acc = state or (0, int(ids[0]), None)
        if acc is not None:
            run = join(run, acc)
        out = zip([k] * len(ids), range(n + 1, n + 1 + len(ids)), [first] * len(ids), ids.tolist(), run.tolist())
        return (n + len(ids), first, int(run[-1])), None, out

    return _by_bucket(stream, key, time_col, seq, value, _ROLLING_OUT, records)


_COUNT_OUT = "key long, pos long, n long, sum long"


def count_window_stream(stream: DataFrame, key: str, time_col: str, seq: str, value: str, size: int,
                        slide: int | None = None) -> DataFrame:
    """Count windows on a stream: every ``slide`` records of a key the sum of
    its last ``size``; the state is the last ``size - 1`` values."""
    slide = slide or size

    def records(k, state, _, __, vals, ___):
        n, kept = state or (0, [])
        all_ = np.array(kept + vals.astype("int64").tolist(), dtype="int64")
        total = np.concatenate([[0], np.cumsum(all_)])
        pos = n + 1 + np.arange(len(vals))
        end = len(kept) + 1 + np.arange(len(vals))
        begin = np.maximum(end - size, 0)
        hit = pos % slide == 0
        new = (n + len(vals), all_[-(size - 1):].tolist() if size > 1 else [])
        if not hit.any():
            return new, None, []
        sums = (total[end] - total[begin])[hit]
        return new, None, zip([k] * len(sums), pos[hit].tolist(), (end - begin)[hit].tolist(), sums.tolist())

    return _by_bucket(stream, key, time_col, seq, value, _COUNT_OUT, records)
