from pyspark.sql import functions as F

from tidepool.operators import alerts, eventtime
from conftest import rows
from fixtures import sensor_df

B = 1549044000
RISING = "\n".join(f"sensor_1,{B + t},{v}" for t, v in
                   [(122, 10), (123, 20), (125, 30), (127, 40), (128, 50), (133, 60), (134, 70), (135, 80)])
TRACE = "\n".join(f"sensor_1,{B + t},1" for t in [122, 123, 125, 127, 128, 124, 133, 124, 134])


def _alerts(df, bounded=True):
    out = alerts.rising_alert(df, ["id"], "et", "seq", "vc", "5 seconds", bounded=bounded)
    return sorted((r.id, int(r.fire_time.timestamp()) - B, r.last_value) for r in out.collect())


def test_rising_alert_fixture(spark):
    assert _alerts(sensor_df(spark, RISING)) == [("sensor_1", 127, 40.0), ("sensor_1", 133, 60.0),
                                                 ("sensor_1", 139, 80.0)]
    assert _alerts(sensor_df(spark, RISING), bounded=False) == [("sensor_1", 127, 40.0),
                                                                ("sensor_1", 133, 60.0)]


def test_rising_alert_sensor(spark):
    assert _alerts(sensor_df(spark)) == [("sensor_1", 120, 10.0), ("sensor_1", 128, 70.0),
                                         ("sensor_2", 130, 60.0), ("sensor_3", 134, 90.0)]


def test_previous_value(spark):
    out = alerts.previous_value(sensor_df(spark), ["id"], ["seq"], "vc")
    got = {}
    for r in sorted(out.collect(), key=lambda r: r.seq):
        got.setdefault(r.id, []).append(r.previous)
    assert got == {"sensor_1": [None, 10, 20, 30, 50, 70], "sensor_2": [None, 40], "sensor_3": [None, 80]}


def test_one_shot_timer(spark):
    out = alerts.one_shot_timer(sensor_df(spark), ["id"], ["seq"], "et", "5 seconds")
    assert sorted((r.id, int(r.fire_time.timestamp()) - B) for r in out.collect()) == [
        ("sensor_1", 127), ("sensor_2", 130), ("sensor_3", 134)]


def test_watermark_trace_fixture(spark):
    df = sensor_df(spark, TRACE)
    t = eventtime.watermark_trace(df, "et", ["seq"], "3 seconds")
    got = [int(r.wm_after.timestamp()) - B for r in sorted(t.collect(), key=lambda r: r.seq)][:5]
    assert got == [119, 120, 122, 124, 125]


def test_window_firings_fixture(spark):
    df = sensor_df(spark, TRACE)
    f = eventtime.window_firings(df, "et", ["seq"], "5 seconds", "3 seconds", "2 seconds")
    got = sorted((int(r.window_start.timestamp()) - B, r.kind, r["count"]) for r in f.collect())
    assert got == [(120, "late", 3), (120, "on_time", 2), (125, "on_time", 3), (130, "end", 2)]
    _, late = eventtime.late_side_output(df, "et", ["seq"], "5 seconds", "3 seconds", "2 seconds")
    assert rows(late, "seq") == [(7,)]


def test_rising_alert_join_walk_equals_segment_runner(spark):
    """Force every segment onto the pointer-doubling walk."""
    spark.conf.set("spark.tidepool.segmentRowLimit", "1")
    try:
        assert _alerts(sensor_df(spark, RISING)) == [("sensor_1", 127, 40.0), ("sensor_1", 133, 60.0),
                                                     ("sensor_1", 139, 80.0)]
        assert _alerts(sensor_df(spark, RISING), bounded=False) == [("sensor_1", 127, 40.0),
                                                                    ("sensor_1", 133, 60.0)]
        assert _alerts(sensor_df(spark)) == [("sensor_1", 120, 10.0), ("sensor_1", 128, 70.0),
                                             ("sensor_2", 130, 60.0), ("sensor_3", 134, 90.0)]
    finally:
        spark.conf.unset("spark.tidepool.segmentRowLimit")
