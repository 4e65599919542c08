"""Sliding windows from steps and blocks equal the direct form."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidepool.operators import ordered, windows
from tidepool.sources.tables import table


def _text(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-1500, 2500)]), rng.choice([None, 1, 2, 3]),
             rng.choice([None, float("nan"), 1.5, -2.0]), rng.choice([None, 5, -7, 9])) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, s long, u int, d double, i int")
    return df.withColumn("ts", F.timestamp_seconds("s")).withColumn("m", F.col("i").cast("decimal(12,2)")).withColumn("one", F.lit(1))


AGGS = [{"n": ("count", "one"), "c": ("count", "u")},
        {"uv": ("count_distinct", "u"), "s": ("sum", "i"), "n": ("count", "i")},
        {"uv": ("count_distinct", "u"), "iv": ("count_distinct", "i")},
        {"mx": ("max", "d"), "mn": ("min", "i"), "s": ("sum", "m"), "n": ("count", "d"), "top": ("max", "k")},
        {"uv": ("count_distinct", "u"), "mx": ("max", "d")}]


@pytest.mark.parametrize("size,slide", [(60, 60), (60, 20), (600, 5)])
@pytest.mark.parametrize("aggs", AGGS, ids=lambda a: "-".join(f for f, _ in a.values()))
def test_equals_direct_form(odd, size, slide, aggs):
    for keys in (["k"], []):
        panes = windows.sliding(odd, "ts", size, slide, keys, aggs)
        direct = windows.sliding(odd.where("ts is not null"), "ts", size, slide, keys, aggs, panes=False)
        assert _text(panes) == _text(direct)


def test_empty_input(odd):
    for aggs in AGGS:
        assert windows.sliding(odd.where("false"), "ts", 60, 20, ["k"], aggs).count() == 0


def test_distinct_with_a_split_user(spark, odd):
    """A user found in more panes than a task reads in one piece."""
    spark.conf.set("spark.tidepool.chunkRows", "20")
    try:
        panes = _text(windows.sliding(odd, "ts", 600, 5, [], {"uv": ("count_distinct", "u")}))
    finally:
        spark.conf.unset("spark.tidepool.chunkRows")
    assert panes == _text(windows.sliding(odd.where("ts is not null"), "ts", 600, 5, [], {"uv": ("count_distinct", "u")}, panes=False))


@pytest.mark.parametrize("form,fns", [(windows._by_blocks, {"v": "max"}), (windows._by_steps, {"v": "count_distinct"})],
                         ids=["blocks", "steps"])
def test_few_rows_per_pane_travel(spark, monkeypatch, form, fns):
    """Before the roll-up a pane is at most two rows (four where a border lies
    between), though it reaches 120 windows."""
    events = table(spark, SF001, "events")
    pane = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events.select((pane - F.pmod(pane, F.lit(5_000_000))).alias("_pane"), F.col("user_id").alias("v"))
    made, array = [], F.array
    monkeypatch.setattr(windows.F, "array", lambda *cols: made.append(len(cols)) or array(*cols))
    out = form(rows, [], fns, 120, 5_000_000)
    assert out.count() > 50 * rows.distinct().count()
    assert made and max(made) <= 4


def test_split_keys_have_as_many_chunks_as_their_size_asks_for(spark):
    df = spark.range(0, 4000).select((F.col("id") % 4).alias("k"), F.col("id").alias("seq"))
    b = ordered.boundaries(df, ["k"], ["seq"], rows=400)              # 1,000 rows a key: three chunks
    sizes = b.apply(df).groupBy("k", "_chunk").count().collect()
    assert b.chunks <= 4 * 4 and len(sizes) == 12 and max(r["count"] for r in sizes) <= 400
    many = ordered.boundaries(df, ["k"], ["seq"], rows=4)             # 250 chunks a key: more than quantiles
    sizes = many.apply(df).groupBy("k", "_chunk").count().collect()
    assert max(r["count"] for r in sizes) <= 12
    first = many.apply(df).groupBy("k", "_chunk").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("k", "_chunk").collect()
    assert all(a["hi"] < c["lo"] for a, c in zip(first, first[1:]) if a["k"] == c["k"])
