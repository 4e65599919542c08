"""Streaming rules on records that come late but are still accepted."""

import datetime
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidepool.session import data_files, ensure_checkpoint_dir, set_times
from tidepool.sinks import writers
from tidepool.streaming import harness, ops, rules

T0 = datetime.datetime(2024, 1, 1)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def replay(spark, batches, schema, transform):
    """One micro-batch per list of rows."""
    root = os.path.join(ensure_checkpoint_dir(spark), "disorder", uuid.uuid4().hex[:8])
    done = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        new = [f for f in data_files(spark, f"{root}/in") if f not in done]
        set_times(spark, new, 1_000_000_000_000 + 1000 * len(done))
        done += new
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    out = transform(s)
    q = (out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


SCHEMA = "k long, t timestamp, id long, v double"


def test_one_shot_timer_of_a_late_record_fires(spark):
    # key 2 comes when the watermark (0 s delay of key 1) has passed its due time
    batches = [[(1, at(0), 0, 1.0)], [(1, at(100), 1, 1.0)], [(2, at(100.5), 2, 1.0), (1, at(300), 3, 1.0)],
               [(3, at(400), 4, 1.0)], [(3, at(500), 5, 1.0)], [(3, at(600), 6, 1.0)]]
    out = replay(spark, batches, SCHEMA, lambda s: rules.one_shot_timer_stream(
        s.withWatermark("t", "60 seconds"), "k", "t", "id", "5 seconds"))
    got = {r["user_id"]: r["fire_us"] for r in out.collect()}
    assert set(got) == {1, 2, 3}


def test_timer_below_the_watermark_fires_at_once(spark):
    batches = [[(1, at(0), 0, 1.0), (1, at(1000), 1, 1.0)], [(2, at(990), 2, 1.0)], [(2, at(991), 3, 1.0), (1, at(3000), 4, 1.0)],
               [(1, at(3001), 5, 0.5)]]
    for make in (lambda s: rules.one_shot_timer_stream(s, "k", "t", "id", "0.001 seconds"),
                 lambda s: rules.rising_alert_stream(s, "k", "t", "id", "v", "0.001 seconds")):
        out = replay(spark, batches, SCHEMA, lambda s: make(s.withWatermark("t", "20 seconds")))
        assert out.count() >= 2


def test_rising_alert_with_a_late_record(spark):
    batches = [[(1, at(0), 0, 5.0)], [(1, at(50), 1, 6.0)], [(2, at(41), 2, 1.0)], [(1, at(200), 3, 1.0)], [(1, at(300), 4, 0.5)]]
    out = replay(spark, batches, SCHEMA, lambda s: rules.rising_alert_stream(
        s.withWatermark("t", "10 seconds"), "k", "t", "id", "v", "1 second"))
    got = {(r["key"], r["last_value"]) for r in out.collect()}
    assert {("1", 5.0), ("2", 1.0)} <= got


def test_next_within_waits_for_late_records(spark):
    schema = "k long, t timestamp, id long, bad boolean"
    # the record at 5 s comes after the one at 8 s and stands between the two failures
    batches = [[(1, at(0), 0, True)], [(1, at(8), 1, True)], [(1, at(5), 2, False)], [(2, at(20), 3, True), (2, at(21), 4, True)],
               [(9, at(900), 5, False)], [(9, at(901), 6, False)], [(9, at(902), 7, False)]]
    out = replay(spark, batches, schema, lambda s: rules.next_within_stream(
        s.withWatermark("t", "10 seconds"), "k", "t", "id", "bad", "1 minute"))
    assert [(r["user_id"], r["first_id"], r["second_id"]) for r in out.collect()] == [(2, 3, 4)]


def test_followed_by_expires_in_order(spark):
    schema = "k long, t timestamp, id long, kind string"
    batches = [[(1, at(0), 0, "a"), (1, at(5), 1, "a"), (1, at(7), 2, "a")], [(1, at(12), 3, "b")],
               [(1, at(13), 4, "a")], [(9, at(900), 5, "x")], [(9, at(901), 6, "x")]]
    out = replay(spark, batches, schema, lambda s: rules.followed_by_within_stream(
        s.withWatermark("t", "1 second"), "k", "t", "id", "kind", "a", "b", "10 seconds"))
    got = sorted((r["kind"], r["first_id"], r["second_id"]) for r in out.collect())
    assert got == [("match", 1, 3), ("match", 2, 3), ("timeout", 0, None), ("timeout", 4, None)]


def test_late_split_allows_the_delay(spark, tmp_path):
    def rows(*times):
        df = spark.createDataFrame([(at(t),) for t in times], "t timestamp")
        return df.withColumn("w", F.window("t", "10 seconds"))
    for delay, late in ((0, 1), (30, 0)):
        main, side = f"{tmp_path}/m{delay}", f"{tmp_path}/l{delay}"
        write = ops.late_split(main, side, "t", "w", "0 seconds", delay)
        write(rows(1, 25), 0)
        write(rows(2), 1)
        write(rows(2), 1)                      # the batch again
        assert spark.read.parquet(side).count() == late and spark.read.parquet(main).count() == 3 - late


def test_hash_keeps_versions_and_reports_damage(spark, tmp_path):
    path = f"{tmp_path}/h"
    assert writers.read_hash(spark, path) is None
    df = lambda *r: spark.createDataFrame(r, "f string, v long, o long")
    writers.upsert_hash(df(("a", 1, 1), ("b", 1, 1)), path, "f", "v", ["o"], version=0)
    writers.upsert_hash(df(("a", 2, 1)), path, "f", "v", ["o"], version=1)
    writers.upsert_hash(df(("a", 2, 1)), path, "f", "v", ["o"], version=1)        # a retried batch
    writers.upsert_hash(df(("b", 3, 1)), path, "f", "v", ["o"])
    want = {"a": 2, "b": 3}
    assert {r["f"]: r["v"] for r in writers.read_hash(spark, path).collect()} == want
    writers.compact_hash(spark, path)
    assert {r["f"]: r["v"] for r in writers.read_hash(spark, path).collect()} == want
    with open(f"{tmp_path}/bad", "w") as f:
        f.write("no table")
    with pytest.raises(Exception):
        writers.read_hash(spark, f"{tmp_path}/bad").collect()


def test_foreach_batch_leaves_finished_batches_out(spark, tmp_path):
    out, done = f"{tmp_path}/out", f"{tmp_path}/done"
    run = writers.foreach_batch(lambda b: b.write.mode("append").parquet(out), done)
    for batch_id in (0, 0, 1):
        run(spark.range(3), batch_id)
    assert spark.read.parquet(out).count() == 6
    again = writers.write_batch(f"{tmp_path}/by_id")
    for batch_id in (0, 0, 1):
        again(spark.range(3), batch_id)
    assert spark.read.parquet(f"{tmp_path}/by_id").count() == 6


def test_staged_input_is_deleted(spark):
    df = spark.range(50).select("id", F.timestamp_seconds("id").alias("t"))
    out = harness.run(df, ["id"], lambda s: s.select("id"), tag="clean")
    assert out.count() == 50
    root = out.inputFiles()[0].split("/sink/")[0].removeprefix("file://")
    assert sorted(os.listdir(root)) == ["sink"]
