"""The interval join of two streams: its state per bucket of keys, against
Spark's own join and brute force."""

import datetime
import decimal
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidepool.session import ensure_checkpoint_dir
from tidepool.streaming import harness, ops, packed_join

B = datetime.datetime(2024, 1, 1)


def _at(seconds):
    return B + datetime.timedelta(seconds=seconds)


def _staged(spark, left, right, batches):
    """Both tables as files of micro-batches, by their column ``n``."""
    root = os.path.join(ensure_checkpoint_dir(spark), "pj", uuid.uuid4().hex[:8])
    for df, to in ((left, "left"), (right, "right")):
        harness.stage(df, ["n"], batches, f"{root}/{to}")
    return root


def _joined(spark, root, keys, times, lower, upper, disorder, **kw):
    """Rows of the sink, and the most rows of state that a micro-batch had."""
    s = [harness.drop_sentinel(harness.read(spark, f"{root}/{x}", spark.read.parquet(f"{root}/{x}").schema)).drop("n")
         for x in ("left", "right")]
    out = f"{root}/{uuid.uuid4().hex[:8]}"
    j = ops.interval_join(*[x.withWatermark(t, disorder) for x, t in zip(s, times)], *keys, *times, lower, upper, **kw)
    with harness._partitions(spark, 1):
        q = j.writeStream.format("parquet").option("checkpointLocation", f"{out}-ck").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(j.schema).parquet(out), max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress)


def test_state_is_a_row_per_bucket(spark):
    n = 6 * packed_join.BUCKETS        # all of them wait in the first micro-batch
    left = spark.range(n).select("id", F.timestamp_seconds(F.col("id") % 60 + 10 ** 9).alias("lt"), F.col("id").alias("n"))
    right = spark.range(n).select(F.col("id").alias("rid"), F.timestamp_seconds(F.col("id") % 60 + 10 ** 9 + 30).alias("rt"),
                                  F.col("id").alias("n"))
    root = _staged(spark, left, right, 2)
    got, state = _joined(spark, root, ("id", "rid"), ("lt", "rt"), "-1 minutes", "1 minutes", "1 hour")
    assert sorted((r["id"], r["rid"]) for r in got.collect()) == [(i, i) for i in range(n)]
    assert state <= packed_join.BUCKETS


@pytest.mark.parametrize("seed", [1, 2])
def test_as_sparks_own_join(spark, seed):
    """Disordered records, some of them late, busy keys and repeated rows."""
    r = random.Random(seed)

    def made(n, step, names):
        rs = [(r.choice([None, 1, 1, 2, 3, r.randrange(40)]), None if r.random() < 0.03 else _at(i * step + r.randint(-150, 30)),
               i, i) for i in range(n)]
        rs += [rs[r.randrange(n)] for _ in range(n // 10)]
        return spark.createDataFrame(rs, f"{names[0]} long, {names[1]} timestamp, {names[2]} long, n long")
    root = _staged(spark, made(300, 4, "ktx"), made(400, 3, ("rk", "rt", "ry")), 5)
    args = (("k", "rk"), ("t", "rt"), "-5 seconds", "15 seconds", "40 seconds")
    got, _ = _joined(spark, root, *args)
    want, _ = _joined(spark, root, *args, packed=False)
    assert rows(got) == rows(want) and got.count() > 100
    assert got.schema.simpleString() == want.schema.simpleString()


def test_range_apart_from_zero_and_old_records(spark):
    """A range that lies after the left records, and records before 1970."""
    left = spark.createDataFrame([("a", _at(0), 0), ("é", _at(1), 1), (None, _at(1), 1), ("a", datetime.datetime(1960, 1, 1), 2),
                                  ("", _at(200), 3)], "k string, t timestamp, n long")
    right = spark.createDataFrame([("a", _at(59), 0), ("a", _at(60), 0), ("é", _at(121), 1), ("", _at(290), 2), ("é", _at(122), 3),
                                   ("a", datetime.datetime(1960, 1, 1, 0, 1), 3)], "rk string, rt timestamp, n long")
    root = _staged(spark, left, right, 3)
    args = (("k", "rk"), ("t", "rt"), "1 minutes", "2 minutes", "1 hour")
    got, want = _joined(spark, root, *args)[0], _joined(spark, root, *args, packed=False)[0]
    assert rows(got) == rows(want) and {("a", _at(60)), ("é", _at(121)), ("", _at(290))} <= set(rows(got, "k", "rt"))


def test_values_stay_exact(spark):
    ddl = ("k int, t timestamp, l long, i int, s short, b byte, o boolean, f float, d double, m decimal(30,7), x string, "
           "y binary, da date, ts timestamp, nt timestamp_ntz, n long")
    far, day = datetime.datetime(9999, 12, 31, 23, 59, 59, 999999), datetime.date
    vals = [(1, _at(0), 2 ** 60 + 1, -2 ** 31, -2 ** 15, -128, True, 0.1, float("nan"), decimal.Decimal("12345678901234567890123.0000001"),
             "", b"", day(1, 1, 1), far, far, 0),
            (2, _at(1), None, None, None, None, None, None, None, None, None, None, None, None, None, 1),
            (3, _at(2), -2 ** 63, 0, 0, 0, False, float("nan"), float("-inf"), decimal.Decimal("-0.0000001"), "é\n\0", b"\0\xff",
             day(9999, 12, 31), datetime.datetime(1583, 1, 1), datetime.datetime(1, 1, 1), 2),
            (4, _at(3), 0, 1, 1, 1, True, float("inf"), -0.0, decimal.Decimal(0), "null", b"null", day(1970, 1, 1), B, B, 3)]
    left = spark.createDataFrame(vals, ddl)
    right = left.select(*[F.col(c).alias(c if c == "n" else f"r_{c}") for c in left.columns]).withColumn("r_k", F.col("r_k").cast("long"))
    root = _staged(spark, left, right, 2)
    args = (("k", "r_k"), ("t", "r_t"), 0, "1 seconds", "1 hour")
    got, want = _joined(spark, root, *args)[0], _joined(spark, root, *args, packed=False)[0]
    assert got.schema.simpleString() == want.schema.simpleString()
    text = [F.col(c).cast("string").alias(c) for c in got.columns]        # NaN is not equal to itself, Python has no year 0
    assert rows(got.select(*text)) == rows(want.select(*text)) and got.count() == 4


def test_other_joins_are_sparks(spark):
    a = spark.readStream.format("rate").load().select("value", F.col("timestamp").alias("t")).withWatermark("t", "1 minute")
    b = a.select(F.col("value").alias("rv"), F.col("t").alias("rt"))
    args = ("value", "rv", "t", "rt")
    assert packed_join.sides(a, b, *args)
    assert not packed_join.sides(a, b.withColumnRenamed("rv", "value"), "value", "value", "t", "rt")
    assert not packed_join.sides(a, b.withColumn("z", F.array("rv")), *args)
    assert not packed_join.sides(a.withColumn("value", F.col("value").cast("double")), b, *args)
    assert not packed_join.sides(a.withColumn("t", F.current_timestamp()), b, *args)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert not packed_join.sides(a, b, *args)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ops.interval_join(a, b, *args, 0, 1, "left_outer").columns == ["value", "t", "rv", "rt"]


def test_matches_of_a_busy_key_come_in_slices(monkeypatch):
    monkeypatch.setattr(packed_join, "SLICE", 7)
    g = np.random.default_rng(0)
    lk, lt, rk, rt = (g.integers(0, n, 60) for n in (3, 50, 4, 50))
    parts = list(packed_join.matches(lk, lt, rk, rt, -3, 6))
    assert max(len(i) for i, _ in parts) == 7
    want = [(i, j) for i in range(60) for j in range(60) if lk[i] == rk[j] and lt[i] - 3 <= rt[j] <= lt[i] + 6]
    assert sorted((int(i), int(j)) for a, b in parts for i, j in zip(a, b)) == want


def test_few_partitions_of_state(spark):
    name = "spark.sql.shuffle.partitions"
    before, cores = spark.conf.get(name), spark.sparkContext.defaultParallelism
    try:
        for session, files, want in ((10 ** 4, 1, 2 * cores), (10 ** 4, 500, 500), (3, 500, 3)):
            spark.conf.set(name, session)
            with harness._partitions(spark, files):
                assert int(spark.conf.get(name)) == want
            assert int(spark.conf.get(name)) == session
    finally:
        spark.conf.set(name, before)
