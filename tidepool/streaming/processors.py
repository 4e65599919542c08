"""Keyed state and timers through ``transformWithStateInPandas``.

``stateful_rule(stream, keys, processor, schema)`` runs a
``StatefulProcessor`` with value, list and map state and event-time timers
(state lives in the RocksDB state store on the executors).  Every access to
state is a round trip between Python and the store, so a
``BucketProcessor`` is run per bucket of keys and keeps the entries of a
bucket's keys together; others are run per key.

* ``RisingAlertProcessor`` — the rising-value alert: value state for the
  previous value, the due time and the last value; an event-time timer per
  running alert.
* ``FirstSeenProcessor``   — map state with a time to live: a value's first
  record, in buckets of values (unique visitors of an unbounded stream).
* ``TimesProcessor``       — list states: records that wait for the watermark
  and the open repetitions of ``begin(a).next(b).times(lo, hi)``.
* ``ArrivalWindowProcessor`` — processing-time windows: a timer per window.
* ``SeenItemsProcessor``   — list state (the keys' values in arrival order)
  and map state (value -> count): emits, per record, how many times its
  value was seen for the key and how many records the key has.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timecols import duration
from .rules import BUCKET, _in_order, factorize, split_keys, with_buckets


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that ``transformWithState`` needs, for queries started
    inside; the session's own setting comes back after that."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stateful_rule(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor,
                  schema: T.StructType, output_mode: str = "append",
                  time_mode: str = "EventTime") -> DataFrame:
    """Run ``processor`` per key, a ``BucketProcessor`` per bucket of keys
    (``transformWithStateInPandas``)."""
    if isinstance(processor, BucketProcessor):
        if len(keys) != 1:
            raise ValueError("a BucketProcessor takes one key column")
        processor.key_col = PACKED_KEY
        stream = with_buckets(stream, keys).withColumn(PACKED_KEY, F.col(keys[0]).cast("string"))
        keys = [BUCKET]
    return stream.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=output_mode,
        timeMode=time_mode)


PACKED_KEY = "packed_key"          # pandas rows rename columns that begin with _


class BucketProcessor(StatefulProcessor):
    """A processor whose group is a bucket of keys.  The key of a record is the
    string in ``key_col`` ("None" for a null)."""

    key_col = PACKED_KEY

    def keys_of(self, pdf: pd.DataFrame) -> pd.Series:
        return pdf[self.key_col].fillna("None")

    def close(self) -> None:
        pass


PACKED = T.StructType([T.StructField("packed", T.BinaryType())])


def _load(state, default):
    return pickle.loads(state.get()[0]) if state.exists() else default


def _store(state, value) -> None:
    if value:
        state.update((pickle.dumps(value, pickle.HIGHEST_PROTOCOL),))
    else:
        state.clear()


ALERT_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                             T.StructField("fire_time", T.TimestampType()),
                             T.StructField("last_value", T.DoubleType())])


class RisingAlertProcessor(StatefulProcessor):
    """Value strictly above the previous one (0 first) starts a timer at
    event time + delay unless one runs; a non-rising record cancels it; the
    timer emits (key, due time, last value)."""

    def __init__(self, time_col: str, seq: str, value: str, delay):
        self.time_col, self.seq, self.value = time_col, seq, value
        self.delay_us = int(round(duration(delay) * 1e6))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        st = T.StructType([T.StructField("prev", T.DoubleType()), T.StructField("due", T.LongType()),
                           T.StructField("last", T.DoubleType())])
        self.state = handle.getValueState("alert", st)

    def _get(self):
        if self.state.exists():
            prev, due, last = self.state.get()
            return float(prev), int(due), float(last)
        return 0.0, -1, 0.0

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        prev, due, last = self._get()
        ts, _, vals = _in_order(rows, self.time_col, self.seq, self.value)
        out = []
        for t, v in zip(ts, vals.astype("float64")):
            if due >= 0 and due < t:
                out.append((str(key[0]), pd.Timestamp(due, unit="us"), last))
                self.handle.deleteTimer(due // 1000)
                due = -1
            if v > prev:
                if due < 0:
                    due = int(t) + self.delay_us
                    self.handle.registerTimer(due // 1000)
            elif due >= 0:
                self.handle.deleteTimer(due // 1000)
                due = -1
            prev, last = float(v), float(v)
        self.state.update((prev, due, last))
        if out:
            yield pd.DataFrame(out, columns=["key", "fire_time", "last_value"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        prev, due, last = self._get()
        if due >= 0:
            self.state.update((prev, -1, last))
            yield pd.DataFrame([(str(key[0]), pd.Timestamp(due, unit="us"), last)],
                               columns=["key", "fire_time", "last_value"])

    def close(self) -> None:
        pass


SEEN_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("seq", T.LongType()),
                            T.StructField("value", T.StringType()),
                            T.StructField("times_seen", T.LongType()),
                            T.StructField("records", T.LongType())])


class SeenItemsProcessor(BucketProcessor):
    """List state of the keys' values and a map value -> count per key: the
    records of the keys of a bucket are a value state, a value's counts per key
    an entry of the map state."""

    def __init__(self, seq: str, value: str):
        self.seq, self.value = seq, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", PACKED)
        self.items = handle.getListState("items", T.StructType([T.StructField("k", T.StringType()),
                                                                T.StructField("v", T.StringType())]))
        self.counts = handle.getMapState("counts", T.StructType([T.StructField("v", T.StringType())]), PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([p.assign(**{self.key_col: self.keys_of(p)}) for p in rows], ignore_index=True)
        pdf = pdf.sort_values([self.key_col, self.seq])
        names, values = pdf[self.key_col].tolist(), pdf[self.value].astype(str).tolist()
        total = _load(self.total, {})
        counts = {}
        for v in set(values):
            counts[v] = pickle.loads(self.counts.getValue((v,))[0]) if self.counts.containsKey((v,)) else {}
        seen, records = [], []
        for k, v in zip(names, values):
            of = counts[v]
            of[k] = of.get(k, 0) + 1
            total[k] = total.get(k, 0) + 1
            seen.append(of[k])
            records.append(total[k])
        for v, of in counts.items():
            self.counts.updateValue((v,), (pickle.dumps(of, pickle.HIGHEST_PROTOCOL),))
        self.items.appendList(list(zip(names, values)))
        _store(self.total, total)
        yield pd.DataFrame({"key": names, "seq": pdf[self.seq].astype("int64").to_numpy(), "value": values,
                            "times_seen": seen, "records": records})


TIMER_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                             T.StructField("fire_time", T.TimestampType())])


class TimerEachProcessor(BucketProcessor):
    """A timer at every record's event time + delay; timers of one key at the
    same time are one timer.  A bucket's pending timers, keys and exact
    microseconds, are a value state in order of time; the engine's timer, which
    counts milliseconds, is set to the earliest of them."""

    def __init__(self, time_col: str, delay):
        self.time_col = time_col
        self.delay_us = int(round(duration(delay) * 1e6))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", PACKED)
        self.next = handle.getValueState("next", T.StructType([T.StructField("ms", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [pd.DataFrame({"us": p[self.time_col].astype("datetime64[us]").astype("int64") + self.delay_us,
                             "key": self.keys_of(p)}) for p in rows]
        yield from self._fire(timerValues, new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.next.clear()
        yield from self._fire(timerValues, [])

    def _fire(self, timerValues, new: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Emits what the watermark has passed and sets the timer for the rest."""
        us, names = _load(self.due, (np.empty(0, dtype="int64"), []))
        due = pd.concat([pd.DataFrame({"us": us, "key": names}), *new]) if len(us) else pd.concat(new) if new else None
        if due is None:
            return
        due = due.drop_duplicates().sort_values("us", kind="stable")
        us, names = due["us"].to_numpy(dtype="int64"), due["key"].tolist()
        # a timer's millisecond is the first at or after its time
        n = int(np.searchsorted(us, timerValues.getCurrentWatermarkInMs() * 1000, side="right"))
        _store(self.due, (us[n:], names[n:]) if n < len(us) else None)
        before = int(self.next.get()[0]) if self.next.exists() else None
        ms = -(-int(us[n]) // 1000) if n < len(us) else None
        if before != ms:
            if before is not None:
                self.handle.deleteTimer(before)
            if ms is None:
                self.next.clear()
            else:
                self.handle.registerTimer(ms)
                self.next.update((ms,))
        if n:
            yield pd.DataFrame({"key": names[:n], "fire_time": us[:n].astype("datetime64[us]")})


FIRST_SCHEMA = T.StructType([T.StructField("us", T.LongType()), T.StructField("seq", T.LongType()),
                             T.StructField("first", T.IntegerType())])


class FirstSeenProcessor(StatefulProcessor):
    """Marks the first record of every value (``first`` 1, else 0).  The values
    of a bucket are the entries of a map state; each leaves the state a
    ``ttl`` after it was last written, without one it stays."""

    def __init__(self, time_col: str, seq: str, value: str, ttl=None):
        self.time_col, self.seq, self.value = time_col, seq, value
        self.ttl_ms = None if ttl is None else int(round(duration(ttl) * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        value = T.StructType([T.StructField("value", T.StringType())])
        self.seen = handle.getMapState("seen", value, T.StructType([T.StructField("seq", T.LongType())]),
                                       ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        us, seq, value = _in_order(rows, self.time_col, self.seq, self.value)
        first, new = [], set()
        for v, s in zip(value, seq):
            v = str(v)
            fresh = v not in new and not self.seen.containsKey((v,))
            if fresh:
                self.seen.updateValue((v,), (int(s),))
            new.add(v)
            first.append(int(fresh))
        yield pd.DataFrame({"us": us, "seq": seq.astype("int64"), "first": pd.Series(first, dtype="int32")})

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, time_col: str, seq: str, value: str, buckets: int, ttl=None) -> DataFrame:
    """``us, seq, first`` of every record: whether its ``value`` comes for the
    first time.  Values are dealt to ``buckets`` groups, so no group holds them
    all; more buckets, more parallel state.  With a ``ttl`` the query needs a
    ``processingTime`` trigger: the state's clock goes on without input, so
    ``availableNow`` would not end."""
    bucket = F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")
    rows = stream.select(bucket.alias("bucket"), time_col, seq, value)
    return stateful_rule(rows, ["bucket"], FirstSeenProcessor(time_col, seq, value, ttl), FIRST_SCHEMA,
                         time_mode="None" if ttl is None else "ProcessingTime")


TIMES_SCHEMA = T.StructType([T.StructField("key", T.LongType()), T.StructField("first_id", T.LongType()),
                             T.StructField("k", T.IntegerType()), T.StructField("ids", T.ArrayType(T.LongType()))])


class TimesProcessor(BucketProcessor):
    """``begin(a).next(b).times(lo, hi).within(t)``: a ``b`` record right after
    an ``a`` record begins a repetition, later ``b`` records go on with it (others
    are skipped).  One row per length from ``lo`` to ``hi`` reached less than
    ``within`` after the start.

    The order inside a key is (time, seq): records wait in a list state until
    the watermark passes them, so a record that comes late but accepted takes
    its place.  A list entry holds the records of one micro-batch and bucket.
    The open repetitions and the last record of every key are a value state;
    each repetition closes at its own length or bound."""

    def __init__(self, time_col: str, seq: str, first: str, repeated: str, lo: int, hi: int, within):
        self.time_col, self.seq, self.first, self.repeated = time_col, seq, first, repeated
        self.lo, self.hi, self.within_us = lo, hi, int(round(duration(within) * 1e6))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PACKED)
        self.open = handle.getValueState("open", PACKED)
        self.due = handle.getValueState("due", T.StructType([T.StructField("ms", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for p in rows:
            us = p[self.time_col].astype("datetime64[us]").astype("int64")
            new += zip(us.tolist(), map(int, p[self.seq].tolist()), map(bool, p[self.first].tolist()),
                       map(bool, p[self.repeated].tolist()), self.keys_of(p).tolist())
        if new:
            self.waiting.appendValue((pickle.dumps(new, pickle.HIGHEST_PROTOCOL),))
        yield from self._pass(timerValues, min((r[0] for r in new), default=None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        yield from self._pass(timerValues, None)

    def _pass(self, timerValues, earliest) -> Iterator[pd.DataFrame]:
        """Takes the records that the watermark has passed, in order."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        due = int(self.due.get()[0]) if self.due.exists() else None
        if earliest is not None and earliest > mark and due is not None and due <= earliest // 1000 + 1:
            return                                    # nothing to take, and the timer is early enough
        waiting = sorted(r for entry in self.waiting.get() for r in pickle.loads(entry[0]))
        ready = [r for r in waiting if r[0] <= mark]
        if ready:
            waiting = waiting[len(ready):]
            if waiting:
                self.waiting.put([(pickle.dumps(waiting, pickle.HIGHEST_PROTOCOL),)])
            else:
                self.waiting.clear()
            yield from self._walk(ready, mark)
        if waiting:
            ms = waiting[0][0] // 1000 + 1
            if due != ms:
                if due is not None:
                    self.handle.deleteTimer(due)
                self.handle.registerTimer(ms)
                self.due.update((ms,))

    def _walk(self, ready, mark) -> Iterator[pd.DataFrame]:
        # key -> (last record was an ``a``: its id and time, open repetitions)
        state = _load(self.open, {})
        out = []
        for us, rid, a, b, k in ready:
            start, runs = state.get(k, (None, ()))
            if b:
                kept = []
                for begun, since, ids in ([*runs, (*start, [])] if start is not None else runs):
                    if us - since < self.within_us:
                        ids = [*ids, rid]
                        if len(ids) >= self.lo:
                            out.append((None if k == "None" else int(k), begun, len(ids), ids))
                        if len(ids) < self.hi:
                            kept.append((begun, since, ids))
                runs = kept
            state[k] = ((rid, us) if a else None, runs)
        left = {}
        for k, (start, runs) in state.items():
            runs = [r for r in runs if mark - r[1] < self.within_us]
            if start is not None or runs:
                left[k] = (start, runs)
        _store(self.open, left)
        if out:
            frame = pd.DataFrame(out, columns=["key", "first_id", "k", "ids"])
            yield frame.astype({"key": "Int64", "k": "int32"})


ARRIVAL_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("window_start", T.TimestampType()),
                               T.StructField("count", T.LongType())])


class ArrivalWindowProcessor(StatefulProcessor):
    """Counts per key and fixed window of the arrival clock.  A window is an
    entry of a map state with a processing-time timer at its end, which emits
    and removes it."""

    def __init__(self, size):
        self.size_ms = int(round(duration(size) * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        start = T.StructType([T.StructField("ms", T.LongType())])
        self.windows = handle.getMapState("windows", start, T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = sum(len(p) for p in rows)
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.size_ms
        if self.windows.containsKey((start,)):
            n += int(self.windows.getValue((start,))[0])
        else:
            self.handle.registerTimer(start + self.size_ms)
        self.windows.updateValue((start,), (n,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size_ms
        if self.windows.containsKey((start,)):
            n = int(self.windows.getValue((start,))[0])
            self.windows.removeKey((start,))
            yield pd.DataFrame([(str(key[0]), pd.Timestamp(start, unit="ms"), n)], columns=["key", "window_start", "count"])

    def close(self) -> None:
        pass


def arrival_windows(stream: DataFrame, key: str, size) -> DataFrame:
    """Processing-time windows: ``key, window_start, count`` once a window of
    the arrival clock is over."""
    return stateful_rule(stream, [key], ArrivalWindowProcessor(size), ARRIVAL_SCHEMA, time_mode="ProcessingTime")


def run_until_idle(query, rows: int, seconds: float, limit: float = 300.0) -> None:
    """Lets a query with processing-time timers run until it has read ``rows``
    records and its timers of the next ``seconds`` have had their time; then
    stops it.  Raises after ``limit`` seconds, or with the query's own error."""
    end = time.monotonic() + limit
    batches: dict[int, int] = {}
    idle_since = None
    while time.monotonic() < end:
        if query.exception() is not None:
            raise query.exception()
        for p in query.recentProgress:
            batches[p["batchId"]] = max(batches.get(p["batchId"], 0), p["numInputRows"])
        if sum(batches.values()) >= rows:
            newest = max(batches)
            idle_since = idle_since or (time.monotonic(), newest)
            # every timer has expired, and a whole micro-batch has run after that
            if time.monotonic() - idle_since[0] > seconds + 1:
                if idle_since[1] < newest - 2:
                    query.stop()
                    return
        time.sleep(0.2)
    query.stop()
    raise TimeoutError(f"the query was not idle after {limit} seconds")
