"""Ordered user reduces, rolling and per window, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.functions import fold
from tidepool.operators import ordered


def Joined():
    """Neither commutative nor built in: text in order, first and last value.
    A local class travels to the workers by value."""
    class Local(fold.Fold):
        state_schema, columns = "text string, first int, last int, n long", ["v", "w"]

        def lift(self, row):
            return f"{row[0]}{row[1] or ''}", row[0], row[0], 1

        def combine(self, earlier, later):
            return earlier[0] + "," + later[0], earlier[1], later[2], earlier[3] + later[3]
    return Local()


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    keys = ["a"] * 6 + ["b", "c", None, float("nan")]
    return [(str(k) if k is not None else None, rng.randrange(0, 900), i, rng.choice([None, rng.randrange(9)]),
             rng.choice(["x", None])) for i in range(700) for k in [rng.choice(keys)]]


def make(spark, data):
    df = spark.createDataFrame(data, "k string, s int, seq int, v int, w string")
    return df.withColumn("t", F.timestamp_seconds("s"))


def brute_rolling(data, by_key=True):
    out, state, f = {}, {}, Joined()
    for k, s, seq, v, w in sorted(data, key=lambda r: (r[1], r[2])):
        k = k if by_key else 0
        state[k] = f.combine(state[k], f.lift((v, w))) if k in state else f.lift((v, w))
        out[seq] = state[k]
    return out


@pytest.mark.parametrize("rows", [None, 20, 3])
@pytest.mark.parametrize("keys", [["k"], []])
def test_rolling_fold(spark, data, rows, keys):
    """Unsplit, and with keys cut into pieces of 20 and 3 rows."""
    df = make(spark, data).repartition(4)
    b = ordered.boundaries(df, keys, ["t", "seq"], rows=rows) if rows else None
    got = fold.rolling_fold(df, keys, ["t", "seq"], Joined(), bounds=b)
    assert got.columns == df.columns + ["text", "first", "last", "n"]
    assert {r["seq"]: (r["text"], r["first"], r["last"], r["n"]) for r in got.collect()} == brute_rolling(data, bool(keys))


def brute_windows(data, size):
    out, f = {}, Joined()
    for k, s, seq, v, w in sorted(data, key=lambda r: (r[1], r[2])):
        key = (k, s // size * size)
        out[key] = f.combine(out[key], f.lift((v, w))) if key in out else f.lift((v, w))
    return out


@pytest.mark.parametrize("deal", ["sorted", "mixed", "one"])
@pytest.mark.parametrize("size", [60, 100_000])
def test_window_reduce(spark, data, deal, size):
    """Input partitions in order, records of a window spread over all
    partitions, and a window that holds everything."""
    df = make(spark, data)
    df = {"sorted": lambda: df.repartitionByRange(5, "t", "seq"), "mixed": lambda: df.repartition(5), "one": lambda: df.coalesce(1)}[deal]()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        rows = fold.window_reduce(df, "t", size, ["k"], ["t", "seq"], Joined()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r["k"], int(r["window_start"].timestamp())): (r["text"], r["first"], r["last"], r["n"]) for r in rows}
    assert len(rows) == len(got) and got == brute_windows(data, size)


def test_empty_and_null_times(spark, data):
    df = make(spark, data)
    assert fold.rolling_fold(df.where("false"), ["k"], ["t", "seq"], Joined()).count() == 0
    assert fold.window_reduce(df.where("false"), "t", 60, ["k"], ["t", "seq"], Joined()).count() == 0
    late = df.withColumn("t", F.when(F.col("seq") % 2 == 0, F.col("t")))
    kept = [r for r in data if r[2] % 2 == 0]
    assert fold.window_reduce(late, "t", 60, [], ["t", "seq"], Joined()).agg(F.sum("n")).first()[0] == len(kept)
