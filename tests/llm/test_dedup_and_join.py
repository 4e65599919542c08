import hashlib
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.llm import ngram_join, substring_dedup

from .conftest import DOCS, passage, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_dedup(rows, k=13):
    """``doc_id -> (n_words, n_removed, kept words)`` by comparing windows."""
    first, out = {}, {}
    for doc, text in sorted((r[0], r[1]) for r in rows):
        w = words(text)
        gone = set()
        for i in range(len(w) - k + 1):
            if first.setdefault(tuple(w[i:i + k]), doc) < doc:
                gone.update(range(i, i + k))
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def brute_components(rows, n=4, threshold=85):
    sets = {}
    for doc, text in ((r[0], r[1]) for r in rows):
        w = words((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    for d, s in sets.items():
        for e in {e for g in s for e in holders[g] if e < d}:
            both = len(s & sets[e])
            if 100 * both >= threshold * (len(s) + len(sets[e]) - both):
                a, b = find(d), find(e)
                up[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_substring_dedup_equals_brute_force(documents, odd_docs):
    got = {r["doc_id"]: r for r in substring_dedup.report(documents).collect()}
    want = brute_dedup(odd_docs)
    assert got.keys() == want.keys()
    for doc, (n, gone, kept) in want.items():
        assert (got[doc]["n_words"], got[doc]["n_removed"]) == (n, gone), doc
        assert got[doc]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_substring_dedup_many_buckets_and_small_runs(documents, odd_docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET", 64)
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.report(documents).collect()}
    assert got == {d: v[1] for d, v in brute_dedup(odd_docs).items()}


def test_equal_hashes_of_other_words_are_found(spark):
    """Spans whose source holds other words are dropped by verification."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = spark.createDataFrame([(1, a), (2, b + " " + a)], "rid long, text string")
    spans = spark.createDataFrame([(2, 0, 18, 1, 0), (2, 30, 18, 1, 0)], substring_dedup.PIECES)
    out = substring_dedup._strip(rows, spans, True)
    checks = out.select(F.explode("checks").alias("c")).select("c.*")
    assert checks.groupBy("src_doc", "src_pos", "len").agg(F.countDistinct("digest").alias("n")).first()["n"] == 2


@pytest.mark.parametrize("bits", [0, 4, 9, 20])
def test_copies_are_kept_when_hashes_collide(spark, documents, odd_docs, bits):
    """With hashes cut to a few bits most windows collide; every digest of
    words still finds its own smallest document."""
    extra = [(500 + i, passage(20 + i % 7, 13 + i) + " " + passage(30 + i % 3, 20), "en", "a", 1) for i in range(25)]
    docs = documents.unionByName(spark.createDataFrame(extra, DOCS)).select(F.col("doc_id").alias("rid"), "text")
    out, _ = substring_dedup.dedup(docs, bits=bits)
    want = brute_dedup(odd_docs + extra)
    got = {r["rid"]: r for r in out.collect()}
    assert len(got) == out.count() == len(want)
    for doc, (n, gone, kept) in want.items():
        assert (got[doc]["n_words"], got[doc]["n_removed"]) == (n, gone), doc
        assert got[doc]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_remove_keeps_columns_and_rows(spark, odd_docs):
    docs = spark.createDataFrame(odd_docs, DOCS).withColumn("rid2", F.lit(1)).withColumn("kept", F.lit("x"))
    out = substring_dedup.remove(docs)
    assert out.columns == docs.columns and out.count() == len(odd_docs)
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    want = brute_dedup(odd_docs)
    for r in odd_docs:
        assert text[r[0]] == (want[r[0]][2] if want[r[0]][1] else r[1])


def test_repeated_and_null_ids(spark):
    t = " ".join(f"v{i}" for i in range(20))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t), (None, None)], "doc_id long, text string")
    got = sorted(r["n_removed"] for r in substring_dedup.report(docs).collect())
    assert got == [0, 0, 20, 20]            # the first row stays whole


def test_join_equals_brute_force(documents, odd_docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents).collect()}
    assert got == brute_components(odd_docs)


def test_join_hubs_and_fragments_do_not_matter(documents, odd_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "FRAGMENT", 100)
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.join(documents, threshold=60).collect()}
    assert got == brute_components(odd_docs, threshold=60)


def test_join_chain_without_hub(spark):
    """A chain in which only neighbours link stays one component."""
    base = [f"c{i}" for i in range(100)]
    rows = [(i, " ".join(base[i * 2:i * 2 + 60])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(docs).collect()}
    want = {d: c for d, (_, c) in brute_components(rows).items()}
    assert got == want and len(set(want.values())) == 1


def _traced(f, *args):
    """The result, and the most bytes that numpy and Python held on the way."""
    tracemalloc.start()
    try:
        return f(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_join_holds_the_words_of_a_piece_only(spark, monkeypatch):
    class Docs:                                          # hands out the function that runs in the workers
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    class Context:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(ngram_join, "TaskContext", Context)
    texts = [None, "", *[" ".join(f"w{i}x{j}" for j in range(400)) for i in range(1100)], "a B c", None]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    total = sum(len(t or "") for t in texts)
    assert 6 * ngram_join.BLOCK < total < 4 << 20        # one block, several pieces
    run = ngram_join._from_texts(Docs(), 5, 7)
    out, most = _traced(lambda: list(run([batch])))
    assert most < 16 * total, (most, total)
    table = pa.Table.from_batches(out)
    assert len(table) == 8
    found = {(i, int(g)) for r in table.to_pylist() if r["gram"] for i, g in
             zip(ngram_join._rows(r["row"], len(r["gram"]) // ngram_join.SHORT), ngram_join._grams(r["gram"], 0))}
    data = "".join(t or "" for t in texts).encode()
    offsets = np.cumsum([0, *[len(t or "") for t in texts]])
    row, gram = ngram_join.shingles(np.frombuffer(data, np.uint8), offsets, 5)
    low = gram & np.uint64((1 << 8 * ngram_join.SHORT) - 1)
    assert found == set(zip(row.tolist(), low.tolist())) and len(found) == 1100 * 396 + 1


@pytest.mark.parametrize("piece", [1, 100, 1 << 30])
def test_join_does_not_depend_on_pieces(piece, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIECE", piece)
    texts = ["", "a b c d e f", "", "A b", passage(1, 50), passage(1, 50) + " " + passage(1, 50), "", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t) for t in texts]])
    row, gram, n, s1, s2 = ngram_join._block(data, offsets, 4)
    row0, gram0 = ngram_join.shingles(data, offsets, 4)
    assert row.tolist() == row0.tolist() and gram.tolist() == gram0.tolist()
    for a, b in zip((n, s1, s2), ngram_join._signature(row0, gram0, len(texts))):
        assert a.tolist() == b.tolist()


def test_distinct_keeps_one_of_each_group(documents, odd_docs):
    got = sorted(r["doc_id"] for r in ngram_join.distinct(documents).collect())
    want = brute_components(odd_docs)
    assert got == sorted(d for d, (_, c) in want.items() if c == d)


def test_empty_tables(empty):
    assert substring_dedup.report(empty).count() == 0
    assert substring_dedup.remove(empty).columns == empty.columns
    assert ngram_join.join(empty).count() == 0
    assert ngram_join.distinct(empty).count() == 0
