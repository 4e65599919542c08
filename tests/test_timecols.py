import datetime

from pyspark.sql import functions as F

from tidepool.functions import timecols
from tidepool.operators import eventtime, windows
from fixtures import sensor_df

B = 1549044000


def test_duration_units():
    d = timecols.duration
    assert [d("5 seconds"), d("1 ms"), d("15 minutes"), d("1 hour"), d("-5 days"), d("2 s"), d(3)] == \
        [5.0, 0.001, 900.0, 3600.0, -432000.0, 2.0, 3.0]


def test_ascending_watermark_trace(spark):
    df = sensor_df(spark)
    t = eventtime.watermark_trace(df, "et", ["seq"], timecols.ASCENDING_DELAY)
    last = sorted(t.collect(), key=lambda r: r.seq)[-1]
    # max so far is 130 (the late 115 row does not move it back); minus 1 ms
    assert last.wm_after == datetime.datetime(2019, 2, 1, 18, 2, 9, 999000)


def test_processing_time_window(spark):
    df = timecols.with_ingest_time(sensor_df(spark))
    assert df.where(F.col("ingest_ts").isNull()).count() == 0
    fixed = df.withColumn("ingest_ts", F.timestamp_seconds(F.lit(B + 122) + F.col("seq")))
    out = windows.tumbling(fixed, "ingest_ts", "5 seconds", ["id"])
    assert out.agg(F.sum("count")).first()[0] == 10
