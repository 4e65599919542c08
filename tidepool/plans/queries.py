"""Every operator mapped onto the driver's tables: ``name -> f(spark, sf_dir)``.

Mappings (whole tables, no sampling):

* keyed event streams  -> ``events`` (key ``user_id``, order ``(ts, event_id)``);
  item / channel number ``k`` from ``props``; page-view = ``event_type='view'``
* arrival order for late data -> ``arrival = ts + (event_id*37 % 3600) s``
* rolling aggregates   -> ``lineitem`` per ``l_suppkey`` in
  ``(l_shipdate, l_orderkey, l_linenumber, l_partkey)`` order (unique)
* two streams          -> ``orders`` x ``lineitem`` on the order key
* text                 -> ``documents.text`` split into lines

Integer results are BIGINT, sums of money are integer cents, so results
compare exactly with the SQL oracle in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (alerts, eventtime, joins, patterns, rolling, transforms, windows)
from ..functions import aggregator, fold
from ..schemas import WATER_SENSOR
from ..session import delete_on_exit
from ..sinks import writers
from ..sources import files
from ..sources.tables import table
from ..streaming import harness, processors
from ..streaming import ops as stream_ops
from ..streaming import rules as stream_rules
from . import analyses

EV_ORDER = ["ts", "event_id"]
LI_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
ARRIVAL = ["arrival", "event_id"]


def _iv(s):
    return F.make_dt_interval(secs=F.lit(s))


def events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return (e.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
             .withColumn("cents", F.round(F.col("value") * 100).cast("bigint")))


def events_arrival(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return e.withColumn("arrival", F.col("ts") + F.make_dt_interval(
        secs=((F.col("event_id") * 37) % 3600).cast("int")))


# --------------------------------------------------------------------------- text

def q_word_count(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    return analyses.word_count(transforms.lines_of(docs, "text"))


def q_word_count_rolling(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return analyses.word_count_rolling(docs, "doc_id", "text")


# --------------------------------------------------------------------------- page views / uv

def q_page_views(spark, sf):
    return analyses.page_views(events(spark, sf), "event_type", "view")


def q_page_views_flatmap(spark, sf):
    """flatMap form: each view becomes ("view", 1) in one filter+map step,
    then summed."""
    pv = transforms.filter_project(events(spark, sf), F.col("event_type") == "view",
                                   event_type=F.lit("view"), one=F.lit(1).cast("bigint"))
    return pv.groupBy("event_type").agg(F.sum("one").alias("count"))


def q_page_views_rolling(spark, sf):
    r = analyses.page_views_rolling(events(spark, sf).select("event_id", "ts", "event_type"),
                                    "event_type", EV_ORDER, "view")
    return r.select("event_id", F.col("count").cast("bigint").alias("count"))


def q_page_views_hourly(spark, sf):
    return analyses.page_views_windowed(events(spark, sf), "event_type", "ts", "1 hour", "view")


def q_unique_visitors(spark, sf):
    return analyses.unique_visitors(events(spark, sf), "event_type", "user_id", "view")


def q_unique_visitors_rolling(spark, sf):
    v = events(spark, sf).where(F.col("event_type") == "view").select("event_id", "ts", "user_id")
    r = rolling.rolling_distinct(v, [], EV_ORDER, "user_id", out="uv")
    return r.select("event_id", "uv")


def q_unique_visitors_hourly(spark, sf):
    return analyses.unique_visitors_windowed(events(spark, sf), "event_type", "user_id", "ts",
                                             "1 hour", "view")


def q_app_marketing(spark, sf):
    e = events(spark, sf)
    key = F.concat(F.lit("ch"), (F.col("k") % 4).cast("string"), F.lit("_"), F.col("event_type"))
    return analyses.key_count(e, key)


def q_app_marketing_no_channel(spark, sf):
    return analyses.key_count(events(spark, sf), F.col("event_type"))


def q_ad_clicks(spark, sf):
    """Orders per (market segment, nation) of the customer.

    Orders are counted per customer first (partial aggregate, one row per
    customer leaves the map side), then joined to customers."""
    per_cust = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    j = per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"])
    key = F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return j.groupBy(key.alias("key")).agg(F.sum("n").alias("count"))


# --------------------------------------------------------------------------- top-N

def q_hot_items(spark, sf):
    e = events(spark, sf).select(F.col("k").alias("item_id"), "ts", "event_type")
    return analyses.hot_items(e, "item_id", "ts", "event_type", "view", "1 hour", "5 minutes", 3)


def q_hot_pages(spark, sf):
    e = events(spark, sf)
    log = e.select(F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("k").cast("string"))
                   .alias("url"), "ts")
    return analyses.hot_pages(log, "url", "ts", "10 minutes", "5 seconds", 3)


# --------------------------------------------------------------------------- rolling (lineitem)

def _li(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")


def q_rolling_sum(spark, sf):
    return rolling.rolling_sum(_li(spark, sf), ["l_suppkey"], LI_ORDER, "l_quantity",
                               keep_first=["l_orderkey", "l_shipdate"])


def q_rolling_max(spark, sf):
    return rolling.rolling_max(_li(spark, sf), ["l_suppkey"], LI_ORDER, "l_quantity",
                               keep_first=["l_orderkey", "l_shipdate"])


def q_rolling_min(spark, sf):
    return rolling.rolling_min(_li(spark, sf), ["l_suppkey"], LI_ORDER, "l_quantity",
                               keep_first=["l_orderkey", "l_shipdate"])


def q_rolling_reduce(spark, sf):
    li = _li(spark, sf).select(
        "l_suppkey", *LI_ORDER,
        F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string")).alias("sid"),
        F.col("l_orderkey").alias("code"), F.col("l_quantity").alias("qty"))
    # fixed values: what later records of a key carry in the other fields
    r = rolling.rolling_reduce(li, ["l_suppkey"], LI_ORDER, "qty",
                               {"sid": F.lit("aaa"), "code": F.lit(123)})
    return r.select("l_suppkey", "pos", "sid", "code", "qty")


def q_rolling_count(spark, sf):
    r = rolling.rolling_count(_li(spark, sf), ["l_suppkey"], LI_ORDER)
    return r.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "count")


def q_rolling_distinct(spark, sf):
    r = rolling.rolling_distinct(_li(spark, sf), ["l_suppkey"], LI_ORDER, "l_partkey")
    return r.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "distinct_count")


# --------------------------------------------------------------------------- record transforms

def q_filter_project(spark, sf):
    li = table(spark, sf, "lineitem")
    return transforms.filter_project(li, F.col("l_returnflag") == "R", l_orderkey="l_orderkey",
                                     l_linenumber="l_linenumber", l_partkey="l_partkey",
                                     one=F.lit(1).cast("bigint"))


def q_explode_map(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.array(F.col("l_quantity").cast("int"), F.col("l_linenumber")).alias("xs"))
    # fixed value: the mapping function and its captured constant
    a = 1
    return transforms.explode_map(li, "xs", lambda n: -n + 10 + a, "value",
                                  keep=["l_orderkey", "l_linenumber", "l_partkey"])


def q_connect_map(spark, sf):
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    return transforms.connect_map(
        li, part,
        lambda d: F.concat_ws(":", d["l_orderkey"].cast("string"), d["l_linenumber"].cast("string")),
        lambda d: (d["p_size"] + 10).cast("string"))


def q_union_all(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    parts = [li.where(F.col("l_returnflag") == f) for f in ("A", "N", "R")]
    return transforms.union_all(*parts)


def _quantity_labels(df, multi=False):
    q = F.col("l_quantity")
    if multi:
        rules = [(q < 10, ["small", "cheap"]), (q < 40, ["medium"])]
    else:
        rules = [(q < 10, ["small"]), (q < 40, ["medium"])]
    return transforms.label_split(df, rules, ["large"])


def q_label_split(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    lab = _quantity_labels(li, multi=True)
    return lab.select(F.explode("labels").alias("label")).groupBy("label").agg(
        F.count(F.lit(1)).alias("count"))


def q_select_label(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    lab = _quantity_labels(li, multi=True)
    return transforms.select_label(lab, "cheap", "large")


def q_side_output(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    main, side = transforms.side_output(
        li, F.col("l_quantity") > 45, l_orderkey="l_orderkey", l_linenumber="l_linenumber",
        message=F.concat(F.lit("quantity "), F.col("l_quantity").cast("bigint").cast("string"),
                         F.lit(" above 45")))
    main = main.select(F.lit("main").alias("stream"), "l_orderkey", "l_linenumber",
                       F.lit(None).cast("string").alias("message"))
    return main.unionByName(side.select(F.lit("side").alias("stream"), "l_orderkey",
                                        "l_linenumber", "message"))


def q_redistribute(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return transforms.redistribute(li, 16)


# --------------------------------------------------------------------------- windows (events)

def q_tumbling(spark, sf):
    return windows.tumbling(events(spark, sf), "ts", "1 hour", ["event_type"],
                            {"count": ("count", F.lit(1)), "cents": ("sum", "cents")})


def q_sliding(spark, sf):
    return windows.sliding(events(spark, sf), "ts", "2 hours", "30 minutes", ["event_type"],
                           {"count": ("count", F.lit(1)), "cents": ("sum", "cents")})


def q_sliding_distinct(spark, sf):
    return windows.sliding(events(spark, sf), "ts", "1 hour", "5 minutes", ["event_type"],
                           {"uv": ("count_distinct", "user_id"), "count": ("count", F.lit(1))})


def q_sliding_extrema(spark, sf):
    """Largest, smallest and summed cents of every 10 min / 5 s window of each
    kind, as totals per kind and hour in which the windows begin."""
    w = windows.sliding(events(spark, sf), "ts", "10 minutes", "5 seconds", ["event_type"],
                        {"high": ("max", "cents"), "low": ("min", "cents"), "cents": ("sum", "cents")})
    return w.groupBy("event_type", F.date_trunc("hour", "window_start").alias("hour")).agg(
        F.count(F.lit(1)).alias("windows"), F.sum("high").alias("high"), F.sum("low").alias("low"),
        F.sum("cents").alias("cents"))


def q_session(spark, sf):
    return windows.session(events(spark, sf), "ts", "6 hours", ["user_id"], "event_id",
                           {"count": ("count", F.lit(1)), "cents": ("sum", "cents")})


def q_count_window(spark, sf):
    return windows.count_window(events(spark, sf), ["user_id"], EV_ORDER, 5, 3, value="cents")


def q_count_window_tumbling(spark, sf):
    return windows.count_window(events(spark, sf), ["user_id"], EV_ORDER, 5, value="cents")


def q_count_window_double(spark, sf):
    """Doubles with nulls: every window aggregates its own records only."""
    e = events(spark, sf).withColumn("x", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    r = windows.count_window(e, ["user_id"], EV_ORDER, 2, value="x", out="highest", agg="max")
    return r.select("user_id", "pos", "n", "highest")


def q_window_all(spark, sf):
    return windows.tumbling(events(spark, sf), "ts", "1 day", [],
                            {"count": ("count", F.lit(1)), "cents": ("sum", "cents")})


def q_window_all_count(spark, sf):
    return windows.count_window(events(spark, sf), [], EV_ORDER, 1000, value="cents")


def q_window_distinct(spark, sf):
    return windows.tumbling(events(spark, sf), "ts", "1 day", ["event_type"],
                            {"uv": ("count_distinct", "user_id")})


def q_window_aggregate(spark, sf):
    """The accumulator contract (create/add/merge/result): count and sum per
    (event type, 1 h window), partial per input partition, merged per key."""
    e = events(spark, sf)
    w = F.window("ts", "1 hour")
    keyed = e.select("event_type", w.start.alias("window_start"), w.end.alias("window_end"), "cents")
    agg = aggregator.Combined(aggregator.CountAggregator("count"), aggregator.SumAggregator("cents", "cents"))
    return aggregator.aggregate(keyed, ["event_type", "window_start", "window_end"], agg)


def q_aggregate_null_keys(spark, sf):
    """User aggregates with null keys and keys beyond 2**53."""
    e = events(spark, sf).withColumn("key", F.when(
        F.col("event_id") % 4 != 0, F.lit(9007199254740993).cast("bigint") + F.col("user_id") % 3))
    agg = aggregator.Combined(aggregator.CountAggregator("count"), aggregator.SumAggregator("cents", "cents"))
    return aggregator.aggregate(e.select("key", "cents"), ["key"], agg)


def q_window_with_end(spark, sf):
    return windows.window_with_end(events(spark, sf), ["event_type"], "ts", "1 hour", "15 minutes",
                                   {"count": ("count", F.lit(1))})


# --------------------------------------------------------------------------- event time

DELAY, LATENESS, WSIZE = "10 minutes", "20 minutes", "1 hour"


def q_watermark_trace(spark, sf):
    t = eventtime.watermark_trace(events_arrival(spark, sf), "ts", ARRIVAL, DELAY)
    return t.select("event_id", "arrival_pos", "wm_before", "wm_after")



def q_window_firings(spark, sf):
    return eventtime.window_firings(events_arrival(spark, sf), "ts", ARRIVAL, WSIZE, DELAY, LATENESS)


def q_late_side_output(spark, sf):
    _, late = eventtime.late_side_output(events_arrival(spark, sf), "ts", ARRIVAL, WSIZE, DELAY,
                                         LATENESS)
    return late.select("event_id", "window_start", "wm_before")


def q_assign_event_time(spark, sf):
    """Epoch milliseconds to an event-time column."""
    e = events(spark, sf).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    t = eventtime.assign_event_time(e, "ms", "ms", "event_time")
    return t.select("event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def access_lines(spark, sf) -> DataFrame:
    """Every event as a line of an access log."""
    e = events(spark, sf)
    at = F.date_format(F.col("ts").cast("timestamp"), files.ACCESS_LOG_TIME_FORMAT)
    return e.select(F.concat_ws(" ", F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")),
                                F.col("user_id").cast("string"), F.lit("-"), at, F.lit("+0000"), F.lit("GET"),
                                F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("k").cast("string")))
                    .alias("value"), "event_id", "ts")


def q_access_log(spark, sf):
    """Access-log lines parsed into typed records, counted per url and hour."""
    log = files.parse_access_log(access_lines(spark, sf).select("value"))
    log = log.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    r = windows.tumbling(log, "event_time", "1 hour", ["method", "url"],
                         {"views": ("count", F.lit(1)), "visitors": ("count_distinct", "user_id")})
    return r.select("method", "url", "window_start", "views", "visitors")


# --------------------------------------------------------------------------- state & timers

def q_previous_value(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "ts", "cents")
    return alerts.previous_value(e, ["user_id"], EV_ORDER, "cents").select(
        "event_id", "user_id", "cents", "previous")


def q_one_shot_timer(spark, sf):
    return alerts.one_shot_timer(events(spark, sf), ["user_id"], EV_ORDER, "ts", "5 seconds")


def q_timer_each(spark, sf):
    return alerts.timer_each(events(spark, sf), ["user_id"], "ts", "5 seconds")


def q_rising_alert(spark, sf):
    e = events(spark, sf).select("user_id", "ts", "event_id", "value")
    return alerts.rising_alert(e, ["user_id"], "ts", "event_id", "value", "6 hours")


# --------------------------------------------------------------------------- joins

def q_reconcile(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             "l_shipdate")
    r = joins.reconcile(o.withColumnRenamed("o_orderkey", "orderkey"),
                        li.withColumnRenamed("l_orderkey", "orderkey"), "orderkey",
                        ["o_orderdate", "orderkey"],
                        ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"],
                        ["o_orderdate"], ["l_linenumber", "l_partkey", "l_suppkey"])
    return r.select("orderkey", "n", "status", F.col("left.o_orderdate").alias("o_orderdate"),
                    F.col("right.l_linenumber").alias("l_linenumber"),
                    F.col("right.l_partkey").alias("l_partkey"),
                    F.col("right.l_suppkey").alias("l_suppkey"))


def q_interval_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    j = joins.interval_join(o, li, "o_orderkey", "o_orderdate", "l_shipdate", "-5 days", "15 days",
                            right_key="l_orderkey")
    return j.select("o_orderkey", "o_orderdate", "l_linenumber", "l_partkey", "l_shipdate")


# --------------------------------------------------------------------------- patterns

def _ev(spark, sf):
    return events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")


def q_pattern_where_or(spark, sf):
    cond = (((F.col("event_type") == "purchase") & (F.col("value") >= 400))
            | (F.col("event_type") == "signup"))
    return patterns.pattern_filter(_ev(spark, sf), cond).select("event_id", "user_id", "event_type")


def q_pattern_next(spark, sf):
    c = F.col("event_type") == "click"
    return patterns.next_pair(_ev(spark, sf), ["user_id"], EV_ORDER, c, c, ["event_id"])


def q_pattern_followed_by(spark, sf):
    return patterns.followed_by(_ev(spark, sf), ["user_id"], EV_ORDER, F.col("event_type") == "view",
                                F.col("event_type") == "purchase", ["event_id"])


def q_pattern_followed_by_any(spark, sf):
    return patterns.followed_by_any(_ev(spark, sf), ["user_id"], EV_ORDER,
                                    F.col("event_type") == "click",
                                    F.col("event_type") == "purchase", ["event_id"], "6 hours")


def q_pattern_times(spark, sf):
    c = F.col("event_type") == "error"
    t = patterns.times(_ev(spark, sf), ["user_id"], EV_ORDER, c, c, ["event_id"], 1, 3, "12 hours")
    return t.select("user_id", "first_event_id", F.col("k").cast("bigint").alias("k"),
                    F.element_at("repeats", -1)["event_id"].alias("last_event_id"))


def q_pattern_steps(spark, sf):
    """Three steps: a view, the first purchase after it, the first error after that, within 12 hours."""
    steps = [(n, F.col("event_type") == n, "followed_by") for n in ("view", "purchase", "error")]
    r = patterns.match_steps(_ev(spark, sf), ["user_id"], EV_ORDER, steps, ["event_id"], "12 hours")
    return r.select("user_id", "view_event_id", "purchase_event_id", "error_event_id")


def q_login_fail_alert(spark, sf):
    return analyses.login_fail_alert(_ev(spark, sf), "user_id", "event_type", EV_ORDER, ["event_id"],
                                     "1 hour", "error")


def _order_pay(spark, sf, timeouts):
    e = _ev(spark, sf)
    r = analyses.order_pay(e, "user_id", "event_type", EV_ORDER, ["event_id", "ts"], "6 hours",
                           "view", "purchase", timeouts=timeouts)
    return r


def q_order_pay(spark, sf):
    r = _order_pay(spark, sf, False)
    return r.select("user_id", "view_event_id", "purchase_event_id",
                    (F.unix_micros(F.col("purchase_ts").cast("timestamp"))
                     - F.unix_micros(F.col("view_ts").cast("timestamp"))).alias("elapsed_us"))


def q_order_timeout(spark, sf):
    return _order_pay(spark, sf, True).select("user_id", "view_event_id")


# --------------------------------------------------------------------------- sources and sinks

def _scratch(spark, tag: str) -> str:
    """A fresh folder in the shared one, deleted at the end of the session."""
    path = harness._run_dir(spark, tag)
    delete_on_exit(spark, path)
    return path


def q_read_lines(spark, sf):
    path = _scratch(spark, "lines")
    events(spark, sf).select(F.concat_ws(",", "event_id", "user_id", "event_type")).write.text(path)
    return files.read_lines(spark, path)


def q_read_records(spark, sf):
    """Sensor records (id, seconds, value) from comma-delimited lines."""
    path = _scratch(spark, "records")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    events(spark, sf).select(F.concat(F.lit("user_"), F.col("user_id")), seconds, "k").write.csv(path)
    return files.read_records(spark, path, WATER_SENSOR)


def q_upsert_hash(spark, sf):
    """The newest cents per user, written in four batches of which one comes
    again, with a compaction between them."""
    path = _scratch(spark, "hash")
    e = events(spark, sf).select(F.col("user_id").cast("string").alias("field"), "cents", "ts", "event_id",
                                 F.least(F.call_function("div", F.dayofmonth("ts"), F.lit(8)), F.lit(3)).alias("batch"))
    for version in (0, 1, 1, 2, 3):
        writers.upsert_hash(e.where(F.col("batch") == version), path, "field", "cents", EV_ORDER, version=version)
        if version == 2:
            writers.compact_hash(spark, path)
    return writers.read_hash(spark, path)


def q_index_docs(spark, sf):
    """A document per order, in two batches of which the second comes again."""
    path = _scratch(spark, "docs")
    o = table(spark, sf, "orders").select(F.concat_ws(",", "o_orderkey", "o_custkey").alias("line"),
                                          (F.col("o_orderkey") % 2).alias("batch"))
    for batch in (0, 1, 1):
        writers.index_docs(o.where(F.col("batch") == batch).drop("batch"), path, "line", batch_id=batch)
    return spark.read.schema("data string, batch_id int").json(path).select("data")


def q_fan_out(spark, sf):
    """Events to three outputs by kind and value; the batch comes twice."""
    path = _scratch(spark, "fan")
    e = events(spark, sf).select("event_id", "event_type", "cents")
    outputs = {"errors": F.col("event_type") == "error", "large": F.col("cents") >= 5000, "all": F.lit(True)}
    for _ in range(2):
        writers.fan_out(e, {f"{path}/{n}": p for n, p in outputs.items()}, batch_id=0)
    out = None
    for n in outputs:
        part = spark.read.parquet(f"{path}/{n}").select(F.lit(n).alias("output"), "event_id")
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------- user folds

class Balance(fold.Fold):
    """A balance that never falls below zero: every record maps a balance x to
    max(x + total, floor); maps follow one another."""

    state_schema, columns = "total bigint, floor bigint", ["amount"]

    def lift(self, row):
        return row[0], 0

    def combine(self, earlier, later):
        return earlier[0] + later[0], max(earlier[1] + later[0], later[1])


class LastWriter(fold.Fold):
    """Kinds in order, the newest value and the number of records."""

    state_schema, columns = "kinds string, cents bigint, count bigint", ["event_type", "cents"]

    def lift(self, row):
        return row[0][:1], row[1], 1

    def combine(self, earlier, later):
        return earlier[0] + later[0], later[1], earlier[2] + later[2]


def q_rolling_fold(spark, sf):
    """Purchases add to a user's balance, errors take away; never below zero."""
    amount = F.when(F.col("event_type") == "purchase", F.col("cents")).when(F.col("event_type") == "error", -F.col("cents"))
    e = events(spark, sf).select("user_id", "ts", "event_id", F.coalesce(amount, F.lit(0)).cast("bigint").alias("amount"))
    r = fold.rolling_fold(e, ["user_id"], EV_ORDER, Balance())
    return r.select("user_id", "event_id", F.greatest("total", "floor").alias("balance"))


def q_window_reduce(spark, sf):
    return fold.window_reduce(events(spark, sf), "ts", "1 day", ["user_id"], EV_ORDER, LastWriter())


# --------------------------------------------------------------------------- streaming twins
# The table is replayed as a stream (tidepool.streaming.harness): files in
# event order, one micro-batch each, then a far-future sentinel record that
# closes every window.  Results equal the batch twin's, so the same oracle.

FAR = "2100-01-01 00:00:00"


def _ev_stream_input(spark, sf):
    e = events(spark, sf)
    return e.withColumn("ts_e", F.col("ts").cast("timestamp"))


def _sentinel_row():
    import datetime
    far = datetime.datetime(2100, 1, 1)
    # a page view far in the future: it passes every filter (so it moves the
    # watermark) and its own window / session never closes
    return {"event_id": -1, "ts": far, "ts_e": far, "user_id": -1, "event_type": "view",
            "value": 0.0, "props": '{"k": 0}', "k": 0, "cents": 0}


def _ntz(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


def q_stream_tumbling(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "1 minute"))
        return stream_ops.windowed_counts(s, "ts_e", "1 hour", None, ["event_type"],
                                          {"count": F.count(F.lit(1)), "cents": F.sum("cents")})
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="tumbling")
    return r.select("event_type", _ntz("window_start"), _ntz("window_end"), "count", "cents")


def q_stream_session(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "1 minute"))
        return stream_ops.session_counts(s, "ts_e", "6 hours", ["user_id"],
                                         {"count": F.count(F.lit(1)), "cents": F.sum("cents")})
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="session")
    return r.select("user_id", _ntz("window_start"), _ntz("window_end"), "count", "cents")


def q_stream_unique_visitors_hourly(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "1 minute"))
        v = s.where(F.col("event_type") == "view")
        return stream_ops.distinct_per_window(v, "ts_e", "1 hour", "user_id")
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="uv")
    return r.select(_ntz("window_start"), _ntz("window_end"), "uv")


def _stream_top(spark, sf, item_col, item, size, slide, count_col, where=None, tag="hot"):
    def t(s):
        s = harness.drop_sentinel(s)
        s = s if where is None else s.where(where)
        return s.select(item.alias(item_col), "ts_e")
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag=tag,
                    writer=stream_ops.top_n_windows("ts_e", item_col, size, slide, 3, "1 minute", count_col))
    return r.select(_ntz("window_end"), item_col, count_col, "rank")


def q_stream_hot_items(spark, sf):
    return _stream_top(spark, sf, "item_id", F.col("k"), "1 hour", "5 minutes", "item_count",
                       F.col("event_type") == "view")


def q_stream_hot_pages(spark, sf):
    """Hot pages from access-log lines: parse, 10 min / 5 s windows with one
    minute of disorder, top 3 per window as it closes."""
    lines = access_lines(spark, sf).withColumn("ts_e", F.col("ts").cast("timestamp"))
    far = {**_sentinel_row(), "value": "10.0.0.0 -1 - 01/01/2100:00:00:00 +0000 GET /view/0"}

    def t(s):
        return files.parse_access_log(s.select("value")).select("url", "event_time")
    r = harness.run(lines, EV_ORDER, t, sentinel={c: far[c] for c in lines.columns}, tag="pages",
                    writer=stream_ops.top_n_windows("event_time", "url", "10 minutes", "5 seconds", 3, "1 minute", "view_count"))
    return r.select(_ntz("window_end"), "url", "view_count", "rank")


def q_stream_login_fail_alert(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "1 minute"))
        s = s.withColumn("failed", F.col("event_type") == "error")
        return stream_rules.next_within_stream(s, "user_id", "ts_e", "event_id", "failed", "1 hour")
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="login")
    return r.where(F.col("user_id") >= 0).select("user_id", F.col("first_id").alias("first_event_id"),
                                                 F.col("second_id").alias("second_event_id"))


def q_stream_reconcile(spark, sf):
    """Orders and lineitem in one stream, matched one to one per order key in
    either order of arrival; what stays alone leaves after 4000 days (the
    two tables' dates are years apart)."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.lit("left").alias("side"),
        F.col("o_orderdate").cast("timestamp").alias("t"), F.col("o_orderkey").alias("id"))
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.lit("right").alias("side"),
        F.col("l_shipdate").cast("timestamp").alias("t"),
        (F.col("l_linenumber") * F.lit(1_000_000_000).cast("bigint") + F.col("l_partkey")).alias("id"))

    def t(s):
        s = harness.drop_sentinel(s.withWatermark("t", "2 days"))
        return stream_rules.reconcile_stream(s, "orderkey", "side", "t", "id", "4000 days")
    import datetime
    far = {"orderkey": -1, "side": "left", "t": datetime.datetime(2100, 1, 1), "id": -1}
    r = harness.run(o.unionByName(li), ["t", "orderkey", "id"], t, sentinel=far, tag="reconcile")
    return r.where(F.col("key") >= 0).select(F.col("key").alias("orderkey"), "n", "left_id", "right_id", "status")


def q_stream_rolling_sum(spark, sf):
    def t(s):
        return stream_rules.rolling_stream(s.select("event_id", "user_id", "ts", "cents"), "user_id", "ts", "event_id",
                                           "cents")
    r = harness.run(events(spark, sf).select("event_id", "user_id", "ts", "cents"), EV_ORDER, t, tag="rolling")
    return r.select(F.col("key").alias("user_id"), "pos", F.col("first_id").alias("first_event_id"),
                    F.col("id").alias("event_id"), F.col("agg").alias("cents"))


def q_stream_count_window(spark, sf):
    def t(s):
        return stream_rules.count_window_stream(s.select("event_id", "user_id", "ts", "cents"), "user_id", "ts",
                                                "event_id", "cents", 5, 3)
    r = harness.run(events(spark, sf).select("event_id", "user_id", "ts", "cents"), EV_ORDER, t, tag="countw")
    return r.select(F.col("key").alias("user_id"), "pos", "n", "sum")


def q_stream_word_count(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")

    def t(s):
        toks = transforms.tokenize(transforms.lines_of(s, "text"), "value")
        return stream_ops.rolling_latest(toks, ["word"], {"count": F.sum("one")})
    return harness.run(docs, ["doc_id"], t, mode="update", keys=["word"], tag="wc")


def q_stream_rising_alert(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "0 seconds"))
        return stream_rules.rising_alert_stream(s, "user_id", "ts_e", "event_id", "value", "6 hours")
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="rise")
    return r.select(F.col("key").cast("bigint").alias("user_id"), _ntz("fire_time"), "last_value")


def q_stream_interval_join(spark, sf):
    """Orders x lineitem as two streams: equi key, shipdate in orderdate
    -5 .. +15 days, watermarks on both sides bound the join state."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate") \
        .withColumn("o_t", F.col("o_orderdate").cast("timestamp"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate") \
        .withColumn("l_t", F.col("l_shipdate").cast("timestamp"))

    def t(ls, rs):
        j = stream_ops.interval_join(ls.withWatermark("o_t", "60 days"), rs.withWatermark("l_t", "60 days"),
                                     "o_orderkey", "l_orderkey", "o_t", "l_t", "-5 days", "15 days")
        return j.select("o_orderkey", "o_orderdate", "l_linenumber", "l_partkey", "l_shipdate")
    return harness.run_join(o, ["o_orderdate", "o_orderkey"], li,
                            ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], t)


def q_stream_previous_value(spark, sf):
    def t(s):
        return stream_rules.previous_value_stream(
            s.select("event_id", "user_id", "ts", "cents"), "user_id", "ts", "event_id", "cents",
            "event_id long, user_id long, cents long, previous long")
    e = events(spark, sf).select("event_id", "user_id", "ts", "cents")
    return harness.run(e, EV_ORDER, t, tag="prev")


def _stream_order_pay(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "0 seconds"))
        return stream_rules.followed_by_within_stream(s, "user_id", "ts_e", "event_id", "event_type",
                                                      "view", "purchase", "6 hours")
    return harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="pay")


def q_stream_order_pay(spark, sf):
    r = _stream_order_pay(spark, sf).where(F.col("kind") == "match")
    return r.select("user_id", F.col("first_id").alias("view_event_id"),
                    F.col("second_id").alias("purchase_event_id"),
                    (F.col("second_us") - F.col("first_us")).alias("elapsed_us"))


def q_stream_order_timeout(spark, sf):
    r = _stream_order_pay(spark, sf).where((F.col("kind") == "timeout") & (F.col("user_id") >= 0))
    return r.select("user_id", F.col("first_id").alias("view_event_id"))


def q_stream_one_shot_timer(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "0 seconds"))
        return stream_rules.one_shot_timer_stream(s, "user_id", "ts_e", "event_id", "5 seconds")
    r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="timer")
    fire = F.timestamp_micros("fire_us").cast("timestamp_ntz")
    return r.where(F.col("user_id") >= 0).select("user_id", fire.alias("fire_time"))


LATE_BATCH_S = 5 * 86400          # a micro-batch holds five days of arrivals


def late_arrivals(spark, sf) -> DataFrame:
    """Events of which some arrive up to 14 days late, with the micro-batch
    that their day of arrival puts them in."""
    e = _ev_stream_input(spark, sf)
    late = F.when((F.col("event_id") * 7919) % 17 == 0, (F.col("event_id") * 37) % 15).otherwise(0)
    return e.withColumn("batch", F.call_function("div", F.unix_seconds("ts_e") + late * 86400, F.lit(LATE_BATCH_S)).cast("int")) \
        .select("event_id", "ts", "ts_e", "event_type", "cents", "batch")


def q_stream_allowed_lateness(spark, sf):
    """Daily windows per kind with a day of disorder and five days of allowed
    lateness: the result in time (revision 0) and every one after a late record."""
    def t(s):
        return stream_ops.windows_with_lateness(
            harness.drop_sentinel(s), "ts_e", "1 day", ["event_type"],
            {"count": F.count(F.lit(1)), "cents": F.sum("cents")}, "1 day", "5 days")
    log = harness.run(late_arrivals(spark, sf), EV_ORDER, t, batch="batch", mode="log", tag="lateness")
    r = stream_ops.revisions(log, ["event_type"], ["count", "cents"], "1 day")
    return r.select("event_type", _ntz("window_start"), _ntz("window_end"), F.col("revision").cast("bigint").alias("revision"),
                    "count", "cents")


def q_stream_unique_visitors(spark, sf):
    """Unique visitors after every page view of an unbounded stream: the first
    view of each user from a map state per bucket of users, then a running
    total over the micro-batches."""
    v = _ev_stream_input(spark, sf).where(F.col("event_type") == "view").select("event_id", "ts", "ts_e", "user_id")

    def t(s):
        return processors.first_seen(harness.drop_sentinel(s), "ts_e", "event_id", "user_id", 16)
    with processors.rocksdb(spark):
        r = harness.run(v, EV_ORDER, t, tag="visitors", writer=stream_ops.running_total(["us", "seq"], "first", "uv"))
    return r.select(F.col("seq").alias("event_id"), "uv")


def _with_disorder(spark, sf):
    """The stream in order of arrival, up to an hour after the event."""
    e = events_arrival(spark, sf).withColumn("ts_e", F.col("ts").cast("timestamp"))
    far = {c: v for c, v in {**_sentinel_row(), "arrival": _sentinel_row()["ts"]}.items() if c in e.columns}
    return e, far


def q_stream_pattern_times(spark, sf):
    e, far = _with_disorder(spark, sf)

    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "2 hours")).withColumn("hit", F.col("event_type") == "error")
        rule = processors.TimesProcessor("ts_e", "event_id", "hit", "hit", 1, 3, "12 hours")
        return processors.stateful_rule(s.select("user_id", "ts_e", "event_id", "hit"), ["user_id"], rule, processors.TIMES_SCHEMA)
    with processors.rocksdb(spark):
        r = harness.run(e, ARRIVAL, t, sentinel=far, tag="times")
    return r.select(F.col("key").alias("user_id"), F.col("first_id").alias("first_event_id"),
                    F.col("k").cast("bigint").alias("k"), F.element_at("ids", -1).alias("last_event_id"))


def q_stream_pattern_followed_by_any(spark, sf):
    e, far = _with_disorder(spark, sf)

    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "2 hours"))
        return stream_ops.followed_by_any(s, "user_id", "ts_e", "event_id", F.col("event_type") == "click",
                                          F.col("event_type") == "purchase", "6 hours")
    r = harness.run(e, ARRIVAL, t, sentinel=far, tag="any")
    return r.select("user_id", F.col("first_id").alias("first_event_id"), F.col("second_id").alias("second_event_id"))


def q_stream_processing_time(spark, sf):
    """Two-second windows of the arrival clock per kind of event.  Which window
    a record meets depends on the clock; that all windows of a kind together
    hold each of its records once does not."""
    import os
    e = events(spark, sf).select("event_id", "ts", "event_type")
    root = harness._run_dir(spark, "arrival")
    src, out, ckpt = (os.path.join(root, x) for x in ("source", "sink", "checkpoint"))
    harness.stage(e, EV_ORDER, harness._files(e), src)
    with processors.rocksdb(spark):
        s = harness.drop_sentinel(harness.read(spark, src, spark.read.parquet(src).schema))
        w = processors.arrival_windows(s, "event_type", "2 seconds")
        q = (w.writeStream.outputMode("append").format("parquet").option("checkpointLocation", ckpt)
             .trigger(processingTime="1 second").start(out))
        processors.run_until_idle(q, e.count(), 2.0)
    harness._clean(spark, out, src, ckpt)
    return spark.read.schema(w.schema).parquet(out).groupBy(F.col("key").alias("event_type")).agg(F.sum("count").alias("count"))


def q_stream_timer_each(spark, sf):
    def t(s):
        s = harness.drop_sentinel(s.withWatermark("ts_e", "0 seconds"))
        return processors.stateful_rule(s.select("user_id", "ts_e"), ["user_id"], processors.TimerEachProcessor("ts_e", "5 seconds"),
                                        processors.TIMER_SCHEMA)
    with processors.rocksdb(spark):
        r = harness.run(_ev_stream_input(spark, sf), EV_ORDER, t, sentinel=_sentinel_row(), tag="each")
    return r.where("key <> '-1'").select(F.col("key").cast("bigint").alias("user_id"), _ntz("fire_time"))


def q_stream_keyed_state(spark, sf):
    """Value, list and map state per user: how often the record's kind was seen
    and how many records the user has."""
    e = events(spark, sf).select("event_id", "ts", "user_id", "event_type")

    def t(s):
        return processors.stateful_rule(s.select("user_id", "event_id", "event_type"), ["user_id"],
                                        processors.SeenItemsProcessor("event_id", "event_type"), processors.SEEN_SCHEMA,
                                        time_mode="None")
    with processors.rocksdb(spark):
        r = harness.run(e, EV_ORDER, t, tag="seen")
    return r.select(F.col("key").cast("bigint").alias("user_id"), F.col("seq").alias("event_id"), "times_seen", "records")


def q_stream_late_split(spark, sf):
    """Records whose daily window is over, one day of disorder and five of
    lateness allowed, go to a side output."""
    e = late_arrivals(spark, sf).withColumn("w", F.window("ts_e", "1 day"))
    late = harness._run_dir(spark, "late")
    harness.run(e, EV_ORDER, harness.drop_sentinel, batch="batch", tag="split",
                writer=lambda out: stream_ops.late_split(out, late, "ts_e", "w", "5 days", "1 day"))
    harness._clean(spark, late)
    return spark.read.parquet(late).select("event_id")


QUERIES = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
