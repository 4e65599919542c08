"""Property: for random keyed sequences and chunk counts, the chunked scans
equal the plain per-key window functions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import ordered
from conftest import rows

row = st.tuples(st.sampled_from(["a", "b", "hot", None]), st.integers(0, 20), st.integers(-5, 5))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=60), st.integers(1, 9))
def test_chunked_scans_equal_windows(spark, data, n):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(data)],
                               "k string, ts int, seq int, v int")
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.lag("v", 2).over(w).alias("p2"), F.lead("v", 1).over(w).alias("n1"))
    run = ordered.running(df, ["k"], ["ts", "seq"], {"s": ("sum", "v")}, n=n)
    nb = ordered.neighbours(df, ["k"], ["ts", "seq"], {"v": "v"}, [-2, 1], n=n)
    got = run.join(nb.select("seq", F.col("nb-2.v").alias("p2"), F.col("nb1.v").alias("n1")), "seq")
    assert rows(got, "seq", "s", "p2", "n1") == rows(exp)
