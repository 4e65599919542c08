"""The registered ordered queries with every key cut into many chunks."""

import time

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from tidepool.functions import aggregator
from tidepool.operators import ordered, windows
from tidepool.plans.oracle import ORACLE
from tidepool.plans.queries import QUERIES
from tidepool.sources.tables import TABLES

ORDERED = ["rolling_sum", "rolling_max", "rolling_min", "rolling_reduce", "rolling_count", "rolling_distinct", "session",
           "count_window", "count_window_tumbling", "count_window_double", "window_all_count", "previous_value",
           "pattern_next", "pattern_followed_by", "pattern_times", "login_fail_alert", "pattern_steps", "order_pay", "order_timeout",
           "reconcile", "rising_alert", "late_side_output", "watermark_trace", "window_firings", "page_views_rolling",
           "unique_visitors_rolling", "word_count_rolling"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def show(v):
        if hasattr(v, "isoformat"):
            return (v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v).isoformat()
        return repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", ORDERED)
def test_query_on_many_chunks(spark, duck, name):
    spark.conf.set("spark.tidepool.chunkRows", "15")
    try:
        df = QUERIES[name](spark, SF001)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.unset("spark.tidepool.chunkRows")
    res = duck.execute(ORACLE[name])
    assert got == _canon([d[0] for d in res.description], res.fetchall())


def test_plans_stay_small_at_ten_thousand_chunks(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    b = ordered.boundaries(df, ["k"], ["seq"], rows=10)
    assert b.chunks > 10_000
    start = time.time()
    r = ordered.running(df, ["k"], ["seq"], {"s": ("sum", "v")}, bounds=b)
    r._jdf.queryExecution().executedPlan()
    assert time.time() - start < 2
    sizes = b.apply(df).groupBy("_chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 40 and sizes[1] > 10_000


def test_double_sums_do_not_depend_on_chunks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SUM_BLOCK", 64)
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"), (F.rand(3) * 1e6).alias("v"))
    df = spark.createDataFrame(df.collect(), df.schema)
    runs = []
    for rows in (10, 97, 10_000):
        b = ordered.boundaries(df, ["k"], ["seq"], rows=rows)
        r = ordered.running(df, ["k"], ["seq"], {"s": ("sum", "v"), "x": ("sum", "v")}, exclusive=["x"], bounds=b)
        runs.append(sorted((t["seq"], t["s"], t["x"]) for t in r.collect()))
    assert runs[0] == runs[1] == runs[2]
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    plain = sorted((t["seq"], t["s"]) for t in df.select("seq", F.sum("v").over(w).alias("s")).collect())
    assert all(abs(a[1] - b[1]) < 1e-6 * abs(b[1]) for a, b in zip(runs[0], plain))


def test_rows_that_tie_or_have_no_time(spark):
    rows = [(1, None, i, i) for i in range(40)] + [(1, 5, 40 + i, i) for i in range(40)] + [(1, 6, 99, 1)]
    df = spark.createDataFrame(rows, "k int, t int, seq int, v int")
    w = Window.partitionBy("k").orderBy("t", "seq")
    want = sorted(map(tuple, df.select("seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                                       F.lag("v").over(w)).collect()))
    b = ordered.boundaries(df, ["k"], ["t", "seq"], rows=10)
    r = ordered.running(df, ["k"], ["t", "seq"], {"s": ("sum", "v")}, bounds=b)
    nb = ordered.neighbours(df, ["k"], ["t", "seq"], {"v": "v"}, [-1], bounds=b)
    got = r.join(nb.select("seq", F.col("nb-1.v").alias("p")), "seq").select("seq", "s", "p")
    assert sorted(map(tuple, got.collect())) == want


def test_count_windows_aggregate_their_own_records(spark):
    nan, inf = float("nan"), float("inf")
    values = [1e17, 1.0, 1.5, inf, 2.0, 2.0, None, None, 3.0, nan, 1.0, 1.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, seq int, v double")
    got = {r["pos"]: r["sum"] for r in windows.count_window(df, ["k"], ["seq"], 2, value="v").collect()}
    assert got[2] == 1e17 and got[4] == inf and got[6] == 4.0 and got[8] is None and got[10] != got[10] and got[12] == 2.0
    low = {r["pos"]: r["m"] for r in windows.count_window(df, ["k"], ["seq"], 2, value="v", agg="min", out="m").collect()}
    assert low[2] == 1.0 and low[8] is None
    n = {r["pos"]: r["c"] for r in windows.count_window(df, ["k"], ["seq"], 4, 2, value="v", agg="count", out="c").collect()}
    assert n == {2: 2, 4: 4, 6: 4, 8: 2, 10: 2, 12: 4}


def test_count_windows_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(windows, "COUNT_BLOCK", 16)
    df = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), (F.col("id") * 7 % 31).alias("v"))
    w = Window.partitionBy("k").orderBy("seq")
    want = df.select("k", F.row_number().over(w).alias("pos"), F.sum("v").over(w.rowsBetween(-6, 0)).alias("sum")).filter("pos % 2 = 0")
    got = windows.count_window(df, ["k"], ["seq"], 7, 2, value="v").select("k", "pos", "sum")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sliding_counts_equal_the_direct_form(spark):
    df = spark.createDataFrame([(k, t) for k in range(3) for t in range(0, 40_000, 37 + 400 * k)], "k int, s long") \
        .withColumn("ts", F.timestamp_seconds("s"))
    a = windows.sliding(df, "ts", "10 minutes", "5 seconds", ["k"])
    b = windows.sliding(df, "ts", "10 minutes", "5 seconds", ["k"], panes=False)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_user_aggregates_with_null_nan_and_large_keys(spark):
    big = 9007199254740993
    rows = [(None, None, 1), (None, None, 2), (big, float("nan"), 3), (big, float("nan"), None), (big - 1, 0.5, 5)] * 50
    df = spark.createDataFrame(rows, "a long, b double, v long").repartition(7)
    agg = aggregator.Combined(aggregator.CountAggregator("n"), aggregator.SumAggregator("v", "s"))
    got = {(r["a"], str(r["b"])): (r["n"], r["s"]) for r in aggregator.aggregate(df, ["a", "b"], agg).collect()}
    assert got == {(None, "None"): (100, 150), (big, "nan"): (100, 150), (big - 1, "0.5"): (50, 250)}
    assert aggregator.aggregate(df.limit(0), ["a"], agg).count() == 0
    assert tuple(aggregator.aggregate(df, [], agg).first()) == (250, 550)
