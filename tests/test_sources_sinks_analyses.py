import os

import pytest
from pyspark.sql import functions as F

from tidepool import schemas
from tidepool.operators import joins, transforms
from tidepool.plans import analyses
from tidepool.sinks import writers
from tidepool.sources import files
from tidepool.functions import aggregator
from conftest import rows

DATA = os.path.join(os.path.dirname(__file__), "data")


def _p(name):
    return os.path.join(DATA, name)


def test_word_count_fixture(spark):
    lines = files.read_lines(spark, _p("word.txt"))
    got = dict(rows(analyses.word_count(lines)))
    assert got == {"hello": 3, "dawn": 2, "word": 1, "man": 1, "do": 1, "you": 1, "like": 1,
                   "beijing": 1}


def test_tokenize_java_split_rules(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("   ",), (" x",)], "value string")
    got = sorted(r.word for r in transforms.tokenize(df).collect())
    # 'a  b ' -> a, '', b ; '' -> '' ; '   ' -> nothing ; ' x' -> '', x
    assert got == sorted(["a", "", "b", "", "", "x"])


def test_read_records_failfast(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("sensor_1,1549044122,10\nsensor_1,notanumber,20\n")
    with pytest.raises(Exception):
        files.read_records(spark, str(bad), schemas.WATER_SENSOR).collect()


def test_ad_clicks_fixture(spark):
    df = files.read_records(spark, _p("AdClickLog.csv"), schemas.AD_CLICK)
    assert df.count() == 143
    got = dict(rows(analyses.key_count(df, F.concat_ws("_", "province", F.col("ad_id").cast("string")))))
    assert len(got) == 13 and got["beijing_1715"] == 123 and got["jiangsu_36156"] == 4


def _orders(spark):
    o = files.with_seq(files.read_records(spark, _p("OrderLog.csv"), schemas.ORDER_EVENT).coalesce(1))
    return o.withColumn("et", F.timestamp_seconds("event_time"))


def _receipts(spark):
    r = files.with_seq(files.read_records(spark, _p("ReceiptLog.csv"), schemas.TX_EVENT).coalesce(1))
    return r.withColumn("et", F.timestamp_seconds("event_time"))


def test_order_pay_and_timeout(spark):
    o = _orders(spark)
    pay = analyses.order_pay(o, "order_id", "event_type", ["et", "seq"], ["event_time"], "15 minutes")
    got = rows(pay, "order_id", "create_event_time", "pay_event_time")
    assert len(got) == 37
    assert sum(p - c for _, c, p in got) == 1232
    assert [p - c for k, c, p in got if k == 34747] == [0]
    to = analyses.order_pay(o, "order_id", "event_type", ["et", "seq"], ["event_time"], "15 minutes",
                            timeouts=True)
    assert sorted(r.order_id for r in to.collect()) == [34756, 34767]


def test_reconcile_and_interval_join(spark):
    o = _orders(spark).where(F.col("event_type") == "pay")
    r = _receipts(spark)
    rec = joins.reconcile(o, r, "tx_id", ["et", "seq"], ["et", "seq"])
    st = rows(rec, "status", "tx_id")
    assert len([s for s in st if s[0] == "matched"]) == 38
    assert [t for s, t in st if s == "left_only"] == ["35jue34we", "88snrn932"]
    assert [t for s, t in st if s == "right_only"] == ["8fdsfae83", "ewr342as4"]
    ij = joins.interval_join(o.select("order_id", "tx_id", F.col("et").alias("ot")),
                             r.select(F.col("tx_id").alias("rtx"), F.col("et").alias("rt")),
                             "tx_id", "ot", "rt", "-5 seconds", "15 seconds", right_key="rtx")
    assert sorted(x.order_id for x in ij.collect()) == [34729, 34730, 34734, 34746, 34747]


def test_login_fail_alert(spark):
    lg = files.with_seq(files.read_records(spark, _p("LoginLog.csv"), schemas.LOGIN_EVENT).coalesce(1))
    lg = lg.withColumn("et", F.timestamp_seconds("event_time"))
    out = analyses.login_fail_alert(lg, "user_id", "event_type", ["et", "seq"], ["event_time"],
                                    "2 seconds")
    got = rows(out, "user_id", "first_event_time", "second_event_time")
    assert [(u, a % 1000, b % 1000) for u, a, b in got] == [(1035, 842, 843), (1035, 843, 844)]


def test_access_log_and_hot_pages(spark, tmp_path):
    lines = ["10.0.0.%d - - 17/05/2015:10:%02d:%02d +0000 GET /%s" % (i % 3, m, s, u)
             for i, (m, s, u) in enumerate([(5, 3, "a"), (5, 4, "b"), (5, 9, "a"), (5, 1, "c"),
                                            (6, 0, "b"), (5, 59, "a"), (7, 30, "c"), (6, 2, "b")])]
    p = tmp_path / "apache.log"
    p.write_text("\n".join(lines))
    log = files.read_access_log(spark, str(p))
    assert log.where(F.col("event_time").isNull()).count() == 0
    top = analyses.hot_pages(log, "url", "event_time", "10 minutes", "5 seconds", 3)
    first = top.orderBy("window_end", "rank").first()
    # the first window (ending 10:05:05) holds /c, /a, /b once each: ties by url
    assert first.url == "/a" and first.view_count == 1
    # a window with fewer than three urls returns what it has
    assert top.groupBy("window_end").count().where("count > 3").count() == 0


def test_topic_payload_and_sinks(spark, tmp_path):
    df = files.read_records(spark, _p("sensor-data.log"), schemas.WATER_SENSOR)
    assert rows(writers.topic_payload(df.select(F.col("id"))), "value")[0] == ("sensor_1",)
    js = writers.topic_payload(df).first().value
    assert js.startswith('{"id":"sensor_')
    raw = spark.createDataFrame([(b"k", b"hello")], "key binary, value binary")
    assert files.topic_values(raw).first().value == "hello"
    # hash upsert: later record of a field overwrites; untouched fields stay
    h = str(tmp_path / "hash")
    w = files.with_seq(df.coalesce(1))
    first = writers.upsert_hash(w, h, "ts", "vc", ["seq"])
    assert first.count() == 10
    upd = spark.createDataFrame([(1549044122, 99, 0)], "ts bigint, vc int, seq bigint")
    second = writers.upsert_hash(upd, h, "ts", "vc", ["seq"])
    got = dict(rows(second, "ts", "vc"))
    assert len(got) == 10 and got[1549044122] == 99 and got[1549044123] == 20
    # documents and fan-out
    docs = str(tmp_path / "docs")
    writers.index_docs(files.read_lines(spark, _p("sensor-data.log")), docs, "value")
    assert spark.read.json(docs).columns == ["data"] and spark.read.json(docs).count() == 10
    a, b = str(tmp_path / "hi"), str(tmp_path / "lo")
    writers.fan_out(df, {a: F.col("vc") >= 50, b: F.col("vc") < 50})
    assert spark.read.parquet(a).count() == 5 and spark.read.parquet(b).count() == 5


def test_label_split_side_output(spark):
    df = files.read_records(spark, _p("sensor-data.log"), schemas.WATER_SENSOR)
    lab = transforms.label_split(df, [(F.col("vc") < 50, ["normal"]), (F.col("vc") < 80, ["warn"])],
                                 ["alarm"])
    assert [transforms.select_label(lab, x).count() for x in ("normal", "warn", "alarm")] == [5, 3, 2]
    main, side = transforms.side_output(df, F.col("vc") > 5, alarm=F.lit("alarm"))
    assert main.count() == 10 and side.count() == 10
    ints = spark.createDataFrame([([1, 2, 3, 4],), ([5, 6, 7, 8],)], "xs array<int>")
    got = [r.value for r in transforms.explode_map(ints, "xs", lambda n: -n + 10 + 1).collect()]
    assert sorted(got, reverse=True) == [10, 9, 8, 7, 6, 5, 4, 3]
    u = transforms.union_all(df, df, df)
    assert u.count() == 30
    c = transforms.connect_map(df, spark.range(1, 7).toDF("n"),
                               lambda d: d["id"], lambda d: (d["n"] + 10).cast("string"))
    assert c.count() == 16


def test_aggregator_contract(spark):
    df = files.read_records(spark, _p("sensor-data.log"), schemas.WATER_SENSOR).repartition(3)
    agg = aggregator.Combined(aggregator.CountAggregator(), aggregator.SumAggregator("vc", "vc"))
    got = rows(aggregator.aggregate(df, ["id"], agg))
    assert got == [("sensor_1", 6, 190), ("sensor_2", 2, 100), ("sensor_3", 2, 170)]


def test_word_count_rolling_and_helpers(spark):
    docs = spark.createDataFrame([(1, "a b a\nb"), (2, "a  ")], "doc_id bigint, text string")
    r = analyses.word_count_rolling(docs, "doc_id", "text")
    assert rows(r, "doc_id", "line_no", "token_pos", "word", "count") == [
        (1, 1, 1, "a", 1), (1, 1, 2, "b", 1), (1, 1, 3, "a", 2), (1, 2, 1, "b", 2), (2, 1, 1, "a", 3)]
    df = files.read_records(spark, _p("sensor-data.log"), schemas.WATER_SENSOR)
    tagged = transforms.fan_out_tags(df, {"hi": F.col("vc") >= 50, "s1": F.col("id") == "sensor_1"})
    assert dict(rows(tagged.groupBy("output").count())) == {"hi": 5, "s1": 6}
    assert transforms.redistribute(df, 3).rdd.getNumPartitions() == 3
    assert transforms.project(df, sid="id", v=F.col("vc") + 1).columns == ["sid", "v"]
    uv = analyses.unique_visitors(df.withColumn("b", F.lit("pv")), "b", "id", approx=True)
    assert uv.first().uv == 3


def test_label_split_variant_b_and_filter(spark):
    df = files.read_records(spark, _p("sensor-data.log"), schemas.WATER_SENSOR)
    # variant B: below 50 and below 80 are both "normal"
    lab = transforms.label_split(df, [(F.col("vc") < 50, ["normal"]), (F.col("vc") < 80, ["normal"])],
                                 ["alarm"])
    assert [transforms.select_label(lab, x).count() for x in ("normal", "alarm")] == [8, 2]
    nums = spark.range(1, 9).toDF("value")
    assert [r.value for r in transforms.filter_rows(nums, F.col("value") % 2 == 0).orderBy("value").collect()] \
        == [2, 4, 6, 8]
