"""Chunked sequence scans equal the plain per-key window forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import ordered
from conftest import rows


def _data(spark):
    # key 'hot' holds most rows; a null key; ties in ts broken by seq
    data = []
    seq = 0
    for i in range(120):
        data.append(("hot", i // 3, seq, (i * 7) % 11))
        seq += 1
    for i in range(9):
        data.append(("cold", i, seq, i % 4))
        seq += 1
    data.append((None, 5, seq, 3))
    data.append(("single", 1, seq + 1, 9))
    return spark.createDataFrame(data, "k string, ts int, seq int, v int")


def test_running_matches_window(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "seq", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"),
                    F.min("v").over(w).alias("mi"), F.count("v").over(w).alias("c"))
    for n in (1, 3, 7, 20):
        got = ordered.running(df, ["k"], ["ts", "seq"],
                              {"s": ("sum", "v"), "m": ("max", "v"), "mi": ("min", "v"),
                               "c": ("count", "v")}, n=n)
        assert rows(got, "k", "seq", "s", "m", "mi", "c") == rows(exp)


def test_running_global_and_exclusive(spark):
    df = _data(spark)
    w = Window.orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("seq", F.max("v").over(w).alias("m"))
    got = ordered.running(df, [], ["ts", "seq"], {"m": ("max", "v")}, n=6, inclusive=False)
    assert rows(got, "seq", "m") == rows(exp)


def test_neighbours_match_lag_lead(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("k", "seq", F.lag("v", 1).over(w).alias("p1"), F.lag("v", 3).over(w).alias("p3"),
                    F.lead("v", 1).over(w).alias("n1"), F.lead("v", 4).over(w).alias("n4"),
                    F.row_number().over(w).alias("pos"))
    for n in (1, 5, 13, 40):
        got = ordered.neighbours(df, ["k"], ["ts", "seq"], {"v": "v"}, [-1, -3, 1, 4], n=n)
        got = got.select("k", "seq", F.col("nb-1.v"), F.col("nb-3.v"), F.col("nb1.v"),
                         F.col("nb4.v"), "nb_pos")
        assert rows(got) == rows(exp)


def test_next_and_previous_match(spark):
    df = _data(spark)
    cond = F.col("v") > 6
    wf = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(1, Window.unboundedFollowing)
    wb = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("k", "seq",
                    F.first(F.when(cond, F.col("seq")), ignorenulls=True).over(wf).alias("nx"),
                    F.last(F.when(cond, F.col("seq")), ignorenulls=True).over(wb).alias("pv"))
    for n in (1, 4, 17):
        a = ordered.next_match(df, ["k"], ["ts", "seq"], cond, {"seq": "seq"}, "m", n=n)
        b = ordered.next_match(df, ["k"], ["ts", "seq"], cond, {"seq": "seq"}, "m", n=n,
                               previous=True)
        got_a = rows(a, "k", "seq", F.col("m.seq"))
        got_b = dict(((r[0], r[1]), r[2]) for r in rows(b, "k", "seq", F.col("m.seq")))
        e = rows(exp)
        assert got_a == [(r[0], r[1], r[2]) for r in e]
        assert all(got_b[(r[0], r[1])] == r[3] for r in e)


def test_edge_cases_empty_single_null(spark):
    empty = spark.createDataFrame([], "k string, ts int, seq int, v int")
    assert ordered.running(empty, ["k"], ["ts", "seq"], {"s": ("sum", "v")}).count() == 0
    assert ordered.neighbours(empty, ["k"], ["ts", "seq"], {"v": "v"}, [-1, 1]).count() == 0
    one = spark.createDataFrame([(None, 1, 0, 5)], "k string, ts int, seq int, v int")
    for n in (1, 4):
        r = ordered.running(one, ["k"], ["ts", "seq"], {"s": ("sum", "v")}, n=n).first()
        assert r.s == 5
        nb = ordered.neighbours(one, ["k"], ["ts", "seq"], {"v": "v"}, [-1, 1], n=n).first()
        assert nb["nb-1"] is None and nb["nb1"] is None and nb["nb_pos"] == 1
        m = ordered.next_match(one, ["k"], ["ts", "seq"], F.lit(True), {"v": "v"}, "m", n=n).first()
        assert m.m is None
