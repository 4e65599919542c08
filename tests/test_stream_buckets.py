"""Replays whose cost per key and per micro-batch stays small: rules by buckets
of keys, windows from panes, micro-batches of several files."""

import datetime
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidepool.session import ensure_checkpoint_dir
from tidepool.streaming import harness, ops, processors, rules

B = datetime.datetime(2024, 1, 1)
KEYS = 3000                        # more than there are buckets


def _at(seconds):
    return B + datetime.timedelta(seconds=seconds)


def _root(spark, tag):
    return os.path.join(ensure_checkpoint_dir(spark), "b", f"{tag}-{uuid.uuid4().hex[:8]}")


def _stream(spark, df, build, tag):
    """Rows of the sink, and the most rows of state that a micro-batch had."""
    root = _root(spark, tag)
    far = {"k": -1, "t": datetime.datetime(2100, 1, 1), "id": -1, "v": 0, "kind": "x", "flag": False}
    harness.stage(df, ["t", "id"], 2, root + "/src", {c: far[c] for c in df.columns})
    s = harness.drop_sentinel(harness.read(spark, root + "/src", spark.read.parquet(root + "/src").schema))
    q = (build(s).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    state = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"])
    return [r for r in spark.read.parquet(root + "/out").collect() if str(r[0]) != "-1"], state


@pytest.fixture(scope="module")
def two_each(spark):
    """Two records of every key, hours apart: the second is larger by one."""
    k = F.expr("id div 2")
    return spark.range(2 * KEYS).select(
        k.alias("k"), F.timestamp_seconds(F.lit(int(B.timestamp())) + (F.col("id") % 2) * 7200).alias("t"), "id",
        (F.col("id") % 2 + 1).alias("v"), F.when(F.col("id") % 2 == 0, "left").otherwise("right").alias("kind"),
        F.lit(True).alias("flag"))


def _marked(s):
    return s.withWatermark("t", "0 seconds")


RULES = {
    "reconcile": (lambda s: rules.reconcile_stream(_marked(s), "k", "kind", "t", "id", "100 days"),
                  lambda k: [(k, 1, 2 * k, 2 * k + 1, "matched")]),
    "rolling": (lambda s: rules.rolling_stream(s, "k", "t", "id", "v"),
                lambda k: [(k, 1, 2 * k, 2 * k, 1), (k, 2, 2 * k, 2 * k + 1, 3)]),
    "count": (lambda s: rules.count_window_stream(s, "k", "t", "id", "v", 2), lambda k: [(k, 2, 2, 3)]),
    "previous": (lambda s: rules.previous_value_stream(s, "k", "t", "id", "v", "k long, id long, previous long"),
                 lambda k: [(k, 2 * k, None), (k, 2 * k + 1, 1)]),
    "rising": (lambda s: rules.rising_alert_stream(_marked(s), "k", "t", "id", "v", "1 hour"),
               lambda k: [(str(k), _at(3600), 1.0), (str(k), _at(10800), 2.0)]),
    "one_shot": (lambda s: rules.one_shot_timer_stream(_marked(s), "k", "t", "id", "5 seconds"),
                 lambda k: [(k, int(_at(5).replace(tzinfo=datetime.UTC).timestamp() * 1e6))]),
    "next": (lambda s: rules.next_within_stream(_marked(s), "k", "t", "id", "flag", "3 hours"),
             lambda k: [(k, 2 * k, 2 * k + 1)]),
    "followed": (lambda s: rules.followed_by_within_stream(_marked(s), "k", "t", "id", "kind", "left", "right", "3 hours"),
                 lambda k: [(k, 2 * k, 2 * k + 1)]),
}


@pytest.mark.parametrize("name", RULES)
def test_rule_keeps_a_row_of_state_per_bucket(spark, two_each, name):
    build, want = RULES[name]
    got, state = _stream(spark, two_each, build, name)
    n = len(want(0)[0])
    assert sorted(tuple(r)[:n] for r in got) == sorted(w for k in range(KEYS) for w in want(k))
    assert state <= rules.BUCKETS


PROCESSORS = {
    "each": (lambda s: processors.stateful_rule(_marked(s), ["k"], processors.TimerEachProcessor("t", "5 seconds"),
                                                processors.TIMER_SCHEMA),
             lambda k: [(str(k), _at(5)), (str(k), _at(7205))], 3),
    "seen": (lambda s: processors.stateful_rule(s, ["k"], processors.SeenItemsProcessor("id", "flag"),
                                                processors.SEEN_SCHEMA, time_mode="None"),
             lambda k: [(str(k), 2 * k, "True", 1, 1), (str(k), 2 * k + 1, "True", 2, 2)], None),
    "times": (lambda s: processors.stateful_rule(
        _marked(s), ["k"], processors.TimesProcessor("t", "id", "flag", "flag", 1, 1, "3 hours"), processors.TIMES_SCHEMA),
        lambda k: [(k, 2 * k, 1, [2 * k + 1])], 4),
}


@pytest.mark.parametrize("name", PROCESSORS)
def test_processor_keeps_its_state_per_bucket(spark, two_each, name):
    build, want, per_bucket = PROCESSORS[name]
    with processors.rocksdb(spark):
        got, state = _stream(spark, two_each, build, name)
    assert sorted(tuple(r) for r in got) == sorted(w for k in range(KEYS) for w in want(k))
    if per_bucket:
        assert state <= per_bucket * rules.BUCKETS


def test_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, _at(0), 1, 5), (2 ** 60 + 1, _at(1), 2, 6), (None, _at(2), 3, 7), (0, _at(3), 4, 8)],
                               "k long, t timestamp, id long, v long")
    got, _ = _stream(spark, df, lambda s: rules.rolling_stream(s, "k", "t", "id", "v"), "null")
    assert sorted(((str(r["key"]), r["pos"], r["first_id"], r["id"], r["agg"]) for r in got)) == [
        ("0", 1, 4, 4, 8), (str(2 ** 60 + 1), 1, 2, 2, 6), ("None", 1, 1, 1, 5), ("None", 2, 1, 3, 12)]


def test_one_shot_timer_survives_later_records(spark):
    """Records of the key in a later micro-batch, before the timer is due, leave it."""
    df = spark.createDataFrame([(1, _at(0), 1), (2, _at(1), 2), (1, _at(2), 3), (2, _at(3), 4)], "k long, t timestamp, id long")
    got, _ = _stream(spark, df, lambda s: rules.one_shot_timer_stream(_marked(s), "k", "t", "id", "5 seconds"), "later")
    assert sorted(r["user_id"] for r in got) == [1, 2]


def test_top_windows_of_a_disordered_stream(spark):
    """Batches as the writer gets them, one of them again, against brute force."""
    batches = [[("a", 0), ("b", 3), ("a", 14)], [("b", 12), ("a", 6), ("a", 26)], [("c", 1), ("b", 24), ("c", 40)],
               [("a", 39), ("z", 10 ** 6)], [("z", 10 ** 6)]]
    path = _root(spark, "top") + "/out"
    write = ops.top_n_windows("t", "item", "10 seconds", "5 seconds", 2, "5 seconds", "n")(path)
    for i, b in enumerate(batches):
        df = spark.createDataFrame([(x, _at(s)) for x, s in b], "item string, t timestamp")
        for _ in range(2 if i == 2 else 1):
            write(df, i)
    counts, seen, mark, want = {}, -10 ** 9, -10 ** 9, []
    for b in batches:
        last, mark = mark, seen - 5
        for x, s in b:
            for end in range(s // 5 * 5 + 5, s // 5 * 5 + 15, 5):
                if end > last:
                    counts.setdefault(end, {}).setdefault(x, 0)
                    counts[end][x] += 1
            seen = max(seen, s)
        for end in [e for e in counts if e <= mark]:
            top = sorted(counts.pop(end).items(), key=lambda c: (-c[1], c[0]))[:2]
            want += [(end, x, n, r + 1) for r, (x, n) in enumerate(top)]
    got = [(int((r["window_end"] - B).total_seconds()), r["item"], r["n"], r["rank"])
           for r in spark.read.option("basePath", path).parquet(f"{path}/batch_id=*").collect()]
    assert sorted(got) == sorted(want)


def test_micro_batches_do_not_grow_in_number(spark, monkeypatch):
    spark.conf.set("spark.tidepool.chunkRows", "20")
    try:
        df = spark.range(400).select("id", F.lit("x" * 100).alias("text"))
        batches, files = harness._split(df)
        assert batches == harness.BATCHES and batches * files >= 400 / 5
        log = harness.run(df, ["id"], lambda s: harness.drop_sentinel(s), mode="log", tag="few")
        # a file that stays empty is not written, which shifts records to earlier micro-batches
        assert log.count() == 400 and log.select("_batch").distinct().count() <= harness.BATCHES
    finally:
        spark.conf.unset("spark.tidepool.chunkRows")
    few, files = harness._split(df)
    monkeypatch.setattr(harness, "FILE_BYTES", 1000)
    assert (few, files) == (4, 1) and harness._split(df) == (4, 12)


def test_join_with_several_files_a_batch(spark, monkeypatch):
    monkeypatch.setattr(harness, "FILE_BYTES", 500)
    left = spark.range(200).select("id", F.timestamp_seconds(F.col("id") * 60 + 10 ** 9).alias("lt"))
    right = spark.range(200).select(F.col("id").alias("rid"), F.timestamp_seconds(F.col("id") * 60 + 10 ** 9 + 30).alias("rt"))
    out = harness.run_join(left, ["lt"], right, ["rt"], lambda a, b: ops.interval_join(
        a.withWatermark("lt", "1 hour"), b.withWatermark("rt", "1 hour"), "id", "rid", "lt", "rt", "-1 minutes", "1 minutes"))
    assert sorted(r["rid"] for r in out.collect()) == list(range(200))
