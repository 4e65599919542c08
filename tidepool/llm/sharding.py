"""Sharding by best-fit-decreasing bin packing.

Equal texts form an indivisible group.  Groups sorted by size, largest first,
enter the bin with the tightest remaining capacity that still holds them; the
bins stand in a balanced order (a sorted list searched by bisection).  Groups
of one size are alike, so the packing runs over the size histogram: a size
with its number of groups.  Different sizes d sum to at least d * (d + 1) / 2
bytes, so the histogram has at most sqrt(2 * bytes) rows, whatever the number
of documents; only it reaches the driver, in order of size, row by row.

``shards`` fixes the number of bins and takes the smallest capacity with which
best fit decreasing needs no more.  A group larger than an even part gets a
bin of its own, and the even part is worked out again without it: a group
stays whole, so its shard is then larger than the others.

Defined cases: a null text counts as empty (size 8) and groups with empty
texts; repeated rows count each; an empty table gives no rows; ties between
groups of one size go by digest.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

ROW_BYTES = 8
SHARDS = 24
BUCKETS = 4096


def pack(histogram: list[tuple[int, int]], capacity: int, max_bins: int | None = None):
    """Best fit decreasing over ``(size, groups)`` in falling order of size.

    Returns runs ``(size, first rank, end rank, bin)`` and the number of bins,
    or ``None`` when ``max_bins`` do not do.  Empty bins open as needed; a
    group larger than ``capacity`` gets a bin to itself.
    """
    free: list[tuple[int, int]] = []         # (remaining capacity, -bin), sorted
    runs, bins = [], 0
    for size, groups in histogram:
        rank = 0
        while rank < groups:
            at = bisect_left(free, (size, -(1 << 62)))
            if at == len(free):
                if max_bins is not None and bins == max_bins:
                    return None
                remaining, number = max(capacity, size), bins
                bins += 1
            else:
                remaining, number = free.pop(at)
                number = -number
            # the tightest bin stays tightest until it no longer holds the size
            n = min(groups - rank, remaining // size)
            runs.append((size, rank, rank + n, number))
            rank += n
            insort(free, (remaining - n * size, -number))
    return runs, bins


def fit(histogram: list[tuple[int, int]], shards: int):
    """Runs that fill ``shards`` bins about evenly: the smallest capacity that
    best fit decreasing can do with, found by bisection."""
    own: list[tuple[int, int, int, int]] = []
    rest, free_bins = list(histogram), shards
    total = sum(s * n for s, n in rest)
    while free_bins > 1 and rest and rest[0][0] * free_bins > total:       # larger than an even part
        size, groups = rest[0]
        rank = sum(1 for r in own if r[0] == size)
        own.append((size, rank, rank + 1, shards - free_bins))
        free_bins, total = free_bins - 1, total - size
        rest = ([(size, groups - 1)] if groups > 1 else []) + rest[1:]
    if not rest:
        return own
    low = max(-(-total // free_bins), rest[0][0])
    best, step = pack(rest, low, free_bins), 1
    high = low
    while best is None:                       # a capacity that will do
        low, high = high + 1, high + step
        best, step = pack(rest, high, free_bins), step * 2
    while low < high:
        mid = (low + high) // 2
        runs = pack(rest, mid, free_bins)
        if runs is None:
            low = mid + 1
        else:
            best, high = runs, mid
    done = {}
    for size, a, _, _ in own:
        done[size] = max(done.get(size, 0), a + 1)
    taken = shards - free_bins
    return own + [(s, a + done.get(s, 0), b + done.get(s, 0), n + taken) for s, a, b, n in best[0]]


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """``shard`` for each row of ``(digest, bytes)`` (a written table)."""
    spark = groups.sparkSession
    sizes = groups.groupBy("bytes").count().orderBy(F.col("bytes").desc())
    histogram = [(r[0], r[1]) for r in sizes.toLocalIterator()]
    runs = fit(histogram, shards)
    runs = spark.createDataFrame(runs, "bytes long, first long, end long, shard int")
    # the rank of a group among those of its size, in order of digest: counts
    # per digest range, summed up, then an order inside a range
    g = groups.withColumn("__b", F.substring("digest", 1, 3))
    per = g.groupBy("bytes", "__b").count()
    before = Window.partitionBy("bytes").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("bytes", "__b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("bytes", "__b").orderBy("digest")
    g = g.withColumn("__in", F.row_number().over(inside) - 1).join(per, ["bytes", "__b"]) \
         .withColumn("rank", F.col("__before") + F.col("__in"))
    hit = (g["bytes"] == runs["bytes"]) & (g["rank"] >= runs["first"]) & (g["rank"] < runs["end"])
    return g.join(runs, hit).select("digest", "shard")


def slots(rows: DataFrame, shard: str = "shard", key: str = "doc_id") -> DataFrame:
    """Adds ``slot``, a gapless number from 0 within each shard, without
    ordering a whole shard in one task.  ``rows`` is a written table."""
    rows = rows.withColumn("__b", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    per = rows.groupBy(shard, "__b").count()
    before = Window.partitionBy(shard).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(shard, "__b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__b").orderBy(key)
    return rows.withColumn("__in", F.row_number().over(inside) - 1).join(per, [shard, "__b"]) \
        .withColumn("slot", (F.col("__before") + F.col("__in")).cast("long")).drop("__b", "__in", "__before")


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, digest, shard, slot`` per document."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = materialize(documents.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest")), "shard-docs")
    groups = materialize(docs.groupBy("digest").agg(F.sum("size").cast("long").alias("bytes")), "shard-groups")
    placed = materialize(docs.join(group_shards(groups, shards), "digest"), "shard-placed")
    return slots(placed)
