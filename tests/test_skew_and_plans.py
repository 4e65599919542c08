"""Scale properties: a hot key is split across chunks; plans push filters
and columns to the scan; no keyed scan collapses into one partition."""

from pyspark.sql import functions as F

from tidepool.operators import ordered, rolling
from tidepool.plans import queries as Q
from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split(spark):
    # one key holds a third of the rows
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    c = ordered.chunked(df, ["k"], ["seq"], n=8)
    sizes = {r["_chunk"]: r["count"] for r in c.groupBy("_chunk").count().collect()}
    hot = c.where("k = 0").groupBy("_chunk").count().collect()
    assert len(hot) >= 3, "the hot key must span several chunks"
    assert max(sizes.values()) < 2.0 * n / 8
    # and the running sum over it is still exact
    r = ordered.running(df, ["k"], ["seq"], {"s": ("sum", "v")}, n=8)
    last = r.where("k = 0").agg(F.max("s")).first()[0]
    assert last == df.where("k = 0").agg(F.sum("v")).first()[0]


def test_keyed_scan_has_no_single_partition_exchange(spark):
    df = rolling.rolling_sum(Q._li(spark, SF001), ["l_suppkey"], Q.LI_ORDER, "l_quantity")
    plan = _plan(df)
    # the only single-partition work allowed is over the small chunk table
    for line in plan.splitlines():
        if "SinglePartition" in line:
            raise AssertionError(line)


def test_filters_and_columns_reach_the_scan(spark):
    df = Q.QUERIES["filter_project"](spark, SF001)
    df.collect()
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_returnflag:string>" in plan


def test_ad_clicks_pre_aggregates_before_join(spark):
    df = Q.QUERIES["ad_clicks"](spark, SF001)
    df.collect()
    plan = _plan(df)
    # orders are reduced to one row per customer before the join
    assert plan.index("partial_count") > 0
