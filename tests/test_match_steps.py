"""Sequences of three and more steps against a record-by-record reading."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import patterns


def brute(rows, kinds, hows, within):
    out, keys = [], {r[0] for r in rows}
    for k in keys:
        seq = sorted((r[1:] for r in rows if r[0] == k), key=lambda r: (r[0], r[1]))
        for i, r in enumerate(seq):
            if r[2] != kinds[0]:
                continue
            match, at = [r], i
            for kind, how in zip(kinds[1:], hows):
                later = seq[at + 1:at + 2] if how == "next" else seq[at + 1:]
                hit = next((j for j, x in enumerate(later) if x[2] == kind), None)
                if hit is None:
                    break
                at += 1 + hit
                match.append(seq[at])
            if len(match) == len(kinds) and (within is None or match[-1][0] - r[0] < within):
                out.append((k, *[m[1] for m in match]))
    return sorted(out, key=str)


@pytest.mark.parametrize("hows", [("followed_by", "followed_by"), ("next", "followed_by"), ("followed_by", "next"),
                                  ("next", "next", "followed_by")])
@pytest.mark.parametrize("chunk", ["7", "1000000"])
def test_steps(spark, hows, chunk):
    rows = [(None if i % 11 == 0 else i % 3, i // 2, i, "abc"[(i * i + i // 5) % 3]) for i in range(150)]
    kinds = ("a", "b", "c", "a")[:len(hows) + 1]
    df = spark.createDataFrame(rows, "k int, s long, id long, kind string").withColumn("t", F.timestamp_seconds("s"))
    steps = [(f"p{i}", F.col("kind") == kind, how) for i, (kind, how) in enumerate(zip(kinds, ("", *hows)))]
    spark.conf.set("spark.tidepool.chunkRows", chunk)
    try:
        got = patterns.match_steps(df, ["k"], ["t", "id"], steps, ["id"], "20 seconds")
        got = sorted(map(tuple, got.select("k", *[f"p{i}_id" for i in range(len(steps))]).collect()), key=str)
    finally:
        spark.conf.unset("spark.tidepool.chunkRows")
    assert got == brute(rows, kinds, hows, 20)
