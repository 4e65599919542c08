import datetime
import os
import uuid

from pyspark.sql import functions as F

from tidepool.operators import alerts
from tidepool.session import ensure_checkpoint_dir
from tidepool.streaming import harness, processors
from fixtures import sensor_df

B = 1549044000


def _run(spark, df, order, build, tag):
    root = os.path.join(ensure_checkpoint_dir(spark), "p", f"{tag}-{uuid.uuid4().hex[:8]}")
    far = datetime.datetime(2100, 1, 1)
    sentinel = {"id": "zz_sentinel", "k": "zz_sentinel", "ts": B + 10_000, "vc": 0.0, "seq": 10_000,
                "et": far, "v": "zz"}
    sentinel = {c: sentinel[c] for c in df.columns}
    harness.stage(df, order, 3, root + "/src", sentinel)
    s = harness.drop_sentinel(harness.read(spark, root + "/src", spark.read.parquet(root + "/src").schema))
    q = (build(s).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    return spark.read.parquet(root + "/out")


def test_rising_alert_processor_equals_batch(spark):
    df = sensor_df(spark).withColumn("vc", F.col("vc").cast("double"))
    # event-time order replay (the bounded batch rule orders by event time)
    out = _run(spark, df, ["et", "seq"], lambda s: processors.stateful_rule(
        s.withWatermark("et", "0 seconds"), ["id"],
        processors.RisingAlertProcessor("et", "seq", "vc", "5 seconds"), processors.ALERT_SCHEMA), "ra")
    got = sorted((r.key, int(r.fire_time.timestamp()) - B, r.last_value) for r in out.collect()
                 if r.key != "zz_sentinel")
    batch = alerts.rising_alert(df, ["id"], "et", "seq", "vc", "5 seconds")
    exp = sorted((r.id, int(r.fire_time.timestamp()) - B, r.last_value) for r in batch.collect())
    assert got == exp == [("sensor_1", 120, 10.0), ("sensor_1", 128, 70.0), ("sensor_2", 130, 60.0),
                          ("sensor_3", 134, 90.0)]


def test_list_and_map_state(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("b", 4, "x")],
                               "k string, seq bigint, v string")
    out = _run(spark, df, ["seq"], lambda s: processors.stateful_rule(
        s, ["k"], processors.SeenItemsProcessor("seq", "v"), processors.SEEN_SCHEMA, time_mode="None"),
        "seen")
    got = sorted((r.key, r.seq, r.times_seen, r.records) for r in out.collect()
                 if r.key != "zz_sentinel")
    assert got == [("a", 1, 1, 1), ("a", 2, 1, 2), ("a", 3, 2, 3), ("b", 4, 1, 1)]


def test_timer_each_processor(spark):
    df = sensor_df(spark).withColumn("vc", F.col("vc").cast("double"))
    out = _run(spark, df, ["et", "seq"], lambda s: processors.stateful_rule(
        s.withWatermark("et", "0 seconds"), ["id"], processors.TimerEachProcessor("et", "5 seconds"),
        processors.TIMER_SCHEMA), "each")
    got = sorted((r.key, int(r.fire_time.timestamp()) - B) for r in out.collect() if r.key != "zz_sentinel")
    exp = sorted((r.id, int(r.fire_time.timestamp()) - B) for r in
                 alerts.timer_each(df, ["id"], "et", "5 seconds").collect())
    assert got == exp and len(got) == 10
