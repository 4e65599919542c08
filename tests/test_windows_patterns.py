from pyspark.sql import functions as F

from tidepool.operators import patterns, rolling, windows
from conftest import rows
from fixtures import SENSOR_CEP, sensor_df

B = 1549044000


def _s(t):
    return int(t.timestamp()) - B


def test_tumbling(spark):
    df = sensor_df(spark)
    out = windows.tumbling(df, "et", "5 seconds", ["id"], {"count": ("count", F.lit(1)), "vc": ("sum", "vc")})
    got = sorted((r.id, _s(r.window_start), r["count"], r.vc) for r in out.collect())
    assert got == [("sensor_1", 115, 1, 10), ("sensor_1", 120, 3, 60), ("sensor_1", 125, 2, 120),
                   ("sensor_2", 125, 2, 100), ("sensor_3", 125, 1, 80), ("sensor_3", 130, 1, 90)]


def test_sliding_panes_equal_direct(spark):
    df = sensor_df(spark)
    a = windows.sliding(df, "et", "5 seconds", "2 seconds", ["id"], panes=False)
    b = windows.sliding(df, "et", "5 seconds", "1 seconds", ["id"])  # panes
    c = windows.sliding(df, "et", "5 seconds", "1 seconds", ["id"], panes=False)
    assert rows(b) == rows(c)
    got = {(r.id, _s(r.window_start)): r["count"] for r in a.collect()}
    s1 = {k[1]: v for k, v in got.items() if k[0] == "sensor_1"}
    assert s1 == {112: 1, 114: 1, 118: 1, 120: 3, 122: 4, 124: 3, 126: 2, 128: 1}


def test_session(spark):
    df = sensor_df(spark)
    out = windows.session(df, "et", "3 seconds", ["id"], "seq")
    got = sorted((r.id, _s(r.window_start), _s(r.window_end), r["count"]) for r in out.collect())
    assert got == [("sensor_1", 115, 118, 1), ("sensor_1", 122, 131, 5),
                   ("sensor_2", 125, 130, 2), ("sensor_3", 129, 133, 2)]


def test_count_window(spark):
    df = sensor_df(spark)
    out = windows.count_window(df, ["id"], ["seq"], 5, 3, value="vc")
    assert rows(out) == [("sensor_1", 3, 3, 60), ("sensor_1", 6, 5, 180)]


def test_rolling(spark):
    df = sensor_df(spark)
    mx = rolling.rolling_max(df, ["id"], ["seq"], "vc", keep_first=["ts"])
    last = {r.id: (r.ts - B, r.vc) for r in mx.collect() if (r.id, r.pos) in
            {("sensor_1", 6), ("sensor_2", 2), ("sensor_3", 2)}}
    assert last == {"sensor_1": (122, 70), "sensor_2": (125, 60), "sensor_3": (129, 90)}
    sm = rolling.rolling_sum(df, ["id"], ["seq"], "vc", keep_first=["ts"])
    assert sm.count() == 10
    red = rolling.rolling_reduce(df.select("id", "ts", "vc", "seq"), ["id"], ["seq"], "vc",
                                 {"id": F.lit("aaa"), "ts": F.lit(123)})
    got = rows(red, "id", "ts", "vc", "pos")
    assert len([r for r in got if r[0] == "aaa"]) == 7
    assert ("aaa", 123, 190, 6) in got and ("sensor_1", 1549044122, 10, 1) in got


def test_rolling_distinct(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "a", 3), (1, "c", 4), (2, "a", 5)],
                               "k int, v string, seq int")
    out = rolling.rolling_distinct(df, ["k"], ["seq"], "v")
    assert rows(out, "seq", "distinct_count") == [(1, 1), (2, 2), (3, 2), (4, 3), (5, 1)]


def test_patterns_cep(spark):
    df = sensor_df(spark, SENSOR_CEP)
    a = F.col("id") == "sensor_1"
    order = ["et", "seq"]
    nxt = patterns.next_pair(df, [], order, a, a, ["ts"])
    assert rows(nxt, "first_ts", "second_ts") == [(B + 115, B + 119), (B + 119, B + 122), (B + 124, B + 127)]
    fb = patterns.followed_by(df, [], order, a, a, ["ts"])
    assert len(rows(fb)) == 4
    fba = patterns.followed_by_any(df, [], order, a, a, ["ts"], within="1 hour")
    assert len(rows(fba)) == 10
    tm = patterns.times(df, [], order, a, a, ["ts"], 1, 3, within="5 seconds")
    got = sorted((r.first_ts - B, [x.ts - B for x in r.repeats]) for r in tm.collect())
    assert got == [(115, [119]), (119, [122]), (124, [127])]


def test_pattern_where_or(spark):
    df = sensor_df(spark)
    cond = ((F.col("id") == "sensor_1") & (F.col("vc") >= 50)) | (F.col("id") == "sensor_2")
    got = rows(patterns.pattern_filter(df, cond), "id", "ts")
    assert [t - B for _, t in got] == [126, 128, 125, 127]
