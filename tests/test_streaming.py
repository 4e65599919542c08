"""Streaming forms against their batch twins (bounded replays)."""

import os
import uuid

from pyspark.sql import functions as F

from tidepool import schemas
from tidepool.session import ensure_checkpoint_dir
from tidepool.sources import files
from tidepool.streaming import harness, ops, rules
from conftest import rows

DATA = os.path.join(os.path.dirname(__file__), "data")


def _dir(spark, tag):
    return os.path.join(ensure_checkpoint_dir(spark), "t", f"{tag}-{uuid.uuid4().hex[:8]}")


def _stage(spark, df, order, tag, n=3):
    path = _dir(spark, tag)
    harness.stage(df, order, n, path)
    return harness.drop_sentinel(harness.read(spark, path, spark.read.parquet(path).schema))


def _run(stream, tag, mode="append"):
    spark = stream.sparkSession
    root = _dir(spark, tag)
    q = (stream.writeStream.outputMode(mode).format("parquet")
         .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    return spark.read.parquet(root + "/out")


def test_stream_interval_join(spark):
    o = files.read_records(spark, os.path.join(DATA, "OrderLog.csv"), schemas.ORDER_EVENT)
    o = o.where("event_type = 'pay'").withColumn("ot", F.timestamp_seconds("event_time"))
    r = files.read_records(spark, os.path.join(DATA, "ReceiptLog.csv"), schemas.TX_EVENT)
    r = r.select(F.col("tx_id").alias("rtx"), F.timestamp_seconds("event_time").alias("rt"))
    so = _stage(spark, o, ["ot"], "o").withWatermark("ot", "30 seconds")
    sr = _stage(spark, r, ["rt"], "r").withWatermark("rt", "30 seconds")
    j = ops.interval_join(so, sr, "tx_id", "rtx", "ot", "rt", "-5 seconds", "15 seconds")
    got = sorted(x.order_id for x in _run(j.select("order_id", "rtx"), "ij").collect())
    assert got == [34729, 34730, 34734, 34746, 34747]


def test_stream_previous_value(spark):
    from fixtures import sensor_df
    df = sensor_df(spark).withColumn("vc", F.col("vc").cast("double"))
    s = _stage(spark, df, ["seq"], "pv")
    out = rules.previous_value_stream(s, "id", "et", "seq", "vc",
                                      "id string, seq bigint, vc double, previous double")
    res = _run(out, "pv")
    got = {}
    for r in sorted(res.collect(), key=lambda r: r.seq):
        got.setdefault(r.id, []).append(r.previous)
    # per key previous value in event-time order inside each micro-batch
    assert got["sensor_2"] == [None, 40.0] and got["sensor_3"] == [None, 80.0]
    assert len(got["sensor_1"]) == 6 and got["sensor_1"][0] is None


def test_stream_window_update_mode_allowed_lateness(spark):
    # update mode re-emits a window when a late (but accepted) record arrives
    from fixtures import sensor_df
    B = 1549044000
    text = "\n".join(f"sensor_1,{B + t},1" for t in [122, 123, 125, 127, 128, 124, 133, 134])
    df = sensor_df(spark, text)
    s = _stage(spark, df, ["seq"], "late", n=4).withWatermark("et", "5 seconds")
    w = ops.windowed_counts(s, "et", "5 seconds")
    res = _run_update(w, "late")
    first_window = [r for r in res if int(r.window_start.timestamp()) - B == 120]
    assert max(r["count"] for r in first_window) == 3        # 122, 123 and the late 124


def _run_update(stream, tag):
    spark = stream.sparkSession
    root = _dir(spark, tag)
    out = []

    def keep(batch, bid):
        out.extend(batch.collect())

    q = (stream.writeStream.outputMode("update").foreachBatch(keep)
         .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def test_stream_late_split(spark):
    from fixtures import sensor_df
    B = 1549044000
    text = "\n".join(f"sensor_1,{B + t},1" for t in [122, 123, 125, 127, 128, 133, 134, 121])
    df = sensor_df(spark, text).withColumn("w", F.window("et", "5 seconds"))
    s = _stage(spark, df, ["seq"], "ls", n=4)
    root = _dir(spark, "lsout")
    main, late = root + "/main", root + "/late"
    q = (s.writeStream.foreachBatch(ops.late_split(main, late, "et", "w", "0 seconds"))
         .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.read.parquet(late), "ts") == [(B + 121,)]
    assert spark.read.parquet(main).count() == 7
