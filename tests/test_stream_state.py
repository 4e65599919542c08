"""Streams with state: revisions of windows, running totals, open repetitions."""

import datetime
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidepool.session import ensure_checkpoint_dir
from tidepool.streaming import harness, ops, processors

B = datetime.datetime(2024, 1, 1)


def _at(seconds):
    return B + datetime.timedelta(seconds=seconds)


def test_revisions_of_a_log(spark):
    """Batch 0 and 1 come while the window [0, 10) is open, 2 and 4 after the
    stream has passed its end by the disorder of 5 seconds."""
    def row(batch, start, n, newest):
        return batch, "a", _at(start), _at(start + 10), n, _at(newest)
    log = spark.createDataFrame([
        row(0, 0, 3, 4), row(1, 0, 5, 9), row(1, 10, 1, 16), row(2, 0, 6, 9), row(2, 10, 2, 18), row(4, 0, 7, 9),
        row(4, 30, 1, 36), row(5, 20, 1, 22)],
        "_batch int, k string, window_start timestamp, window_end timestamp, n int, _newest timestamp")
    got = sorted((int((r["window_start"] - B).total_seconds()), r["revision"], r["n"])
                 for r in ops.revisions(log, ["k"], ["n"], "5 seconds").collect())
    # [20, 30) is first seen after its close: it has no result in time, only a late one
    assert got == [(0, 0, 5), (0, 1, 6), (0, 2, 7), (10, 0, 2), (20, 1, 1), (30, 0, 1)]
    last = {int((r["window_start"] - B).total_seconds()): r["n"] for r in ops.newest(log, ["k"], ["n"]).collect()}
    assert last == {0: 7, 10: 2, 20: 1, 30: 1}


def test_running_total_survives_a_retry(spark, tmp_path):
    write = ops.running_total(["seq"], "one", "total")(str(tmp_path / "out"))
    first = spark.createDataFrame([(3, 1), (1, 1), (2, 0)], "seq int, one int")
    second = spark.createDataFrame([(4, 1), (5, 1)], "seq int, one int")
    for batch, i in ((first, 0), (first, 0), (second, 1), (second, 1), (second.where("false"), 2)):
        write(batch, i)
    got = {r["seq"]: r["total"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 3, 5: 4}


def _stream(spark, df, order, build, tag, n=3):
    root = os.path.join(ensure_checkpoint_dir(spark), "p", f"{tag}-{uuid.uuid4().hex[:8]}")
    far = {c: None for c in df.columns} | {"k": -1, "t": datetime.datetime(2100, 1, 1), "id": -1, "a": False, "b": False, "o": 10 ** 6}
    harness.stage(df, order, n, root + "/src", {c: far[c] for c in df.columns})
    s = harness.drop_sentinel(harness.read(spark, root + "/src", spark.read.parquet(root + "/src").schema))
    q = (build(s).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    return spark.read.parquet(root + "/out").collect()


@pytest.fixture(scope="module")
def events(spark):
    """Records that arrive up to 8 seconds out of order, some of both kinds."""
    rng = random.Random(2)
    rows = [(rng.randrange(3), _at(i // 2), i, rng.random() < 0.5, rng.random() < 0.6) for i in range(160)]
    return [(*r, i + rng.randrange(16)) for i, r in enumerate(rows)]


def brute_times(events, lo, hi, within):
    out = set()
    for key in {r[0] for r in events}:
        seq = sorted((r for r in events if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, start in enumerate(seq[:-1]):
            if not start[3] or not seq[i + 1][4]:
                continue
            reps = [r for r in seq[i + 1:] if r[4]][:hi]
            for k in range(lo, hi + 1):
                if len(reps) >= k and (reps[k - 1][1] - start[1]).total_seconds() < within:
                    out.add((key, start[2], k, tuple(r[2] for r in reps[:k])))
    return out


@pytest.mark.parametrize("lo,hi,within", [(1, 3, 12), (2, 2, 5)])
def test_times_on_a_disordered_stream(spark, events, lo, hi, within):
    df = spark.createDataFrame(events, "k long, t timestamp, id long, a boolean, b boolean, o int")
    rule = processors.TimesProcessor("t", "id", "a", "b", lo, hi, within)
    with processors.rocksdb(spark):
        got = _stream(spark, df, ["o", "id"], lambda s: processors.stateful_rule(
            s.withWatermark("t", "30 seconds").select("k", "t", "id", "a", "b"), ["k"], rule, processors.TIMES_SCHEMA), "times", 4)
    rows = [(r["key"], r["first_id"], r["k"], tuple(r["ids"])) for r in got]
    assert len(rows) == len(set(rows)) and set(rows) == brute_times(events, lo, hi, within)


def test_followed_by_any_on_a_disordered_stream(spark, events):
    df = spark.createDataFrame(events, "k long, t timestamp, id long, a boolean, b boolean, o int")
    got = _stream(spark, df, ["o", "id"], lambda s: ops.followed_by_any(
        s.withWatermark("t", "30 seconds"), "k", "t", "id", F.col("a"), F.col("b"), 4), "any")
    want = {(x[0], x[2], y[2]) for x in events for y in events if x[0] == y[0] and x[3] and y[4]
            and (x[1], x[2]) < (y[1], y[2]) and (y[1] - x[1]).total_seconds() < 4}
    rows = [(r["k"], r["first_id"], r["second_id"]) for r in got]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_first_seen_in_buckets(spark, events):
    df = spark.createDataFrame([(r[0], r[1], r[2]) for r in events], "k long, t timestamp, id long")
    with processors.rocksdb(spark):
        got = _stream(spark, df, ["t", "id"], lambda s: processors.first_seen(s, "t", "id", "k", 2), "first")
    firsts = {min(r[2] for r in events if r[0] == k) for k in {r[0] for r in events}}
    assert {r["seq"] for r in got if r["first"]} - {-1} == firsts
    assert sorted({r["seq"] for r in got} - {-1}) == sorted(r[2] for r in events)
