"""Exact top-k inner products with KD-trees per shard.

Vectors are dealt over shards of at most about ``shard_rows`` rows.  Each
shard builds a KD-tree: median splits on the widest axis, every node with the
tight bounding box of its vectors.  The largest inner product of a query with
anything in a box is at most sum(max(q * low, q * high)), so a best-first
traversal visits boxes in falling order of that bound and stops below the
query's kth score.

A query is searched first in one shard; the kth score found there goes with it
to the other shards, which prune with it from their root on.  Queries travel
in blocks, so a task holds one shard and one block of queries.  A box is left
out only when its bound is below the kth score, never when equal: a tie may
still win by its smaller id.

Components are integers, so scores are exact: float64 products as long as
every sum stays below 2**53, else 64-bit integers.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, as query or as candidate; vectors of another length
than the query's never pair with it; equal vectors stay in one leaf when no
axis splits them; repeated rows are candidates of their own, and a query's own
id is never its candidate.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF = 512


class Tree:
    """A KD-tree over integer vectors (rows of ``x``) with ids."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        self.nodes: list[tuple[np.ndarray, np.ndarray, int, int, int, int]] = []
        order = np.argsort(ids, kind="stable")
        self.ids, x = ids[order], x[order]
        perm = np.arange(len(ids))
        stack, self.leaf = [(0, len(ids), -1, False)], leaf
        low, high, begin, end, child = [], [], [], [], []
        while stack:
            a, b, parent, right = stack.pop()
            me = len(begin)
            box = x[perm[a:b]]
            lo, hi = box.min(axis=0), box.max(axis=0)
            low.append(lo), high.append(hi), begin.append(a), end.append(b), child.append([-1, -1])
            if parent >= 0:
                child[parent][right] = me
            axis = int(np.argmax(hi - lo))
            if b - a > leaf and hi[axis] > lo[axis]:
                mid = (b - a) // 2
                part = np.argpartition(box[:, axis], mid, kind="introselect")
                perm[a:b] = perm[a:b][part]
                stack.append((a, a + mid, me, False))
                stack.append((a + mid, b, me, True))
        self.x, self.ids = x[perm], self.ids[perm]
        self.low, self.high = np.array(low), np.array(high)
        self.begin, self.end, self.child = begin, end, child

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bounds (queries x nodes) of the inner product with a box."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        return plus @ self.high.T + minus @ self.low.T

    def search(self, qid: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray):
        """Top k per query: rows ``(query row, id, score)``, only scores at or
        above the query's ``floor``."""
        out = []
        bounds = self.bounds(q)
        for i in range(len(q)):
            best: list[tuple[int, int]] = []           # heap of (score, -id)
            least = floor[i]
            heap = [(-bounds[i, 0], 0)]
            while heap and -heap[0][0] >= least:
                _, node = heapq.heappop(heap)
                left, right = self.child[node]
                if left >= 0:
                    for c in (left, right):
                        if bounds[i, c] >= least:
                            heapq.heappush(heap, (-bounds[i, c], c))
                    continue
                a, b = self.begin[node], self.end[node]
                scores = self.x[a:b] @ q[i]
                near = np.flatnonzero(scores >= least)
                if len(near) > 4 * k:       # by score, ties by id; k + 1 as the query may be among them
                    near = near[np.lexsort((self.ids[a:b][near], -scores[near]))[:k + self._same(qid[i], a, b)]]
                for j in near:
                    if self.ids[a + j] == qid[i]:
                        continue
                    item = (scores[j], -self.ids[a + j])
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    least = max(least, best[0][0])
            out.extend((i, -neg, s) for s, neg in best)
        return out

    def _same(self, qid: int, a: int, b: int) -> int:
        return int((self.ids[a:b] == qid).sum())


def _matrix(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.int64)
    big = float(np.abs(x).max(initial=0))
    return x.astype(np.float64) if big * big * x.shape[1] < 2.0 ** 53 else x


def _search(key, vectors: pd.DataFrame, queries: pd.DataFrame, k: int, leaf: int) -> pd.DataFrame:
    empty = pd.DataFrame({"qkey": pd.Series(dtype="int64"), "query_id": pd.Series(dtype="int64"),
                          "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if not len(vectors) or not len(queries):
        return empty
    both = _matrix(pd.concat([vectors["x"], queries["x"]], ignore_index=True))
    tree = Tree(vectors["vec_id"].to_numpy(np.int64), both[:len(vectors)], leaf)
    qid = queries["vec_id"].to_numpy(np.int64)
    floor = queries["kth"].to_numpy(dtype=np.float64, na_value=-np.inf)
    found = tree.search(qid, both[len(vectors):], k, floor)
    if not found:
        return empty
    at, ids, scores = zip(*found)
    at = np.array(at)
    return pd.DataFrame({"qkey": queries["qkey"].to_numpy(np.int64)[at], "query_id": qid[at],
                         "vec_id": np.array(ids, dtype=np.int64), "score": np.array(scores).astype(np.int64)})


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best rows per query, with ``rank``; Catalyst keeps only k rows per
    query and map task before it shuffles."""
    order = Window.partitionBy("qkey").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES, leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest inner products.

    ``vectors`` and ``queries`` are ``(vec_id long, x array<long>)`` rows.
    """
    vectors = materialize(vectors.filter(F.size("x") > 0).withColumn("dim", F.size("x")), "kd-vectors")
    queries = materialize(queries.filter(F.size("x") > 0).withColumn("dim", F.size("x"))
                          .withColumn("qkey", F.monotonically_increasing_id()), "kd-queries")
    n_shards = max(1, -(-vectors.count() // shard_rows))
    n_blocks = max(1, -(-queries.count() // block_queries))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int")
    block = F.pmod(F.xxhash64("qkey"), F.lit(n_blocks)).cast("int")
    vectors = vectors.withColumn("shard", shard).select("shard", "dim", "vec_id", "x") \
                     .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    queries = queries.withColumn("block", block).withColumn("home", F.pmod(F.xxhash64("qkey", F.lit(1)), F.lit(n_shards)).cast("int"))
    schema = "qkey long, query_id long, vec_id long, score long"

    def run(asked: DataFrame) -> DataFrame:
        left = vectors.groupBy("shard", "block", "dim")
        return left.cogroup(asked.groupBy("shard", "block", "dim")).applyInPandas(
            lambda key, v, q: _search(key, v, q, k, leaf), schema)

    first = queries.withColumn("shard", F.col("home")).withColumn("kth", F.lit(None).cast("double"))
    found = materialize(_top(run(first), k), "kd-first")
    kth = found.filter(F.col("rank") == k).select("qkey", F.col("score").cast("double").alias("kth"))
    rest = queries.join(kth, "qkey", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))) \
                  .filter("shard <> home")
    return _top(found.drop("rank").unionByName(run(rest)), k).select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, x)`` with every component as floor(scale * component);
    vectors that are null or hold null or non-finite components are left out."""
    e = F.col("embedding")
    fine = e.isNotNull() & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(e, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return embeddings.filter(fine & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
