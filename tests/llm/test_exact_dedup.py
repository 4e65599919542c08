"""Exact dedup against brute force, with and without frequent digests."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidepool.llm import exact_dedup

from .conftest import DOCS

DELETE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        text = r[1] or ""
        groups[text.translate(DELETE)].append((-len(text), r[0] is None, r[0] or 0))
    return {t: (min(g)[2] if not min(g)[1] else None, len(g)) for t, g in groups.items()}


def check(rows, report):
    groups = brute(rows)
    got = report.collect()
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
    text_of = defaultdict(list)
    for r in rows:
        text_of[r[0]].append(hashlib.sha256((r[1] or "").translate(DELETE).encode()).hexdigest())
    kept = defaultdict(int)
    for r in got:
        keep, n = by_hash[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (keep, n), r
        assert r["text_sha256"] in text_of[r["doc_id"]]
        assert not r["kept"] or r["doc_id"] == keep
        kept[r["text_sha256"]] += r["kept"]
    assert kept == {h: 1 for h in by_hash}


@pytest.fixture(scope="module")
def rows(odd_docs):
    spread = [(1000 + i, "a" + " " * (i % 7) + "b\tc\r\n", "en", "hot", 1) for i in range(900)]
    twice = [(5000, "same row", "en", "a", 1)] * 3 + [(None, "same row ", "en", "a", 1), (None, "no id", "en", "a", 1)]
    return odd_docs + spread + twice


def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    check(rows, exact_dedup.report(docs))


def test_unique_ids_equal_brute_force(spark, odd_docs):
    check(odd_docs, exact_dedup.report(spark.createDataFrame(odd_docs, DOCS).repartition(4)))


def test_frequent_digest_is_found_and_the_rest_too(spark, rows):
    """With few counters rare digests overflow the summary: the copies of the
    hot text are settled by the broadcast table, all others by the shuffle."""
    docs = spark.createDataFrame(rows + [(10_000 + i, f"own text {i}", "en", "b", 1) for i in range(500)], DOCS).repartition(5)
    numbered = exact_dedup.with_row_ids(docs)
    digests = exact_dedup._digests(numbered)
    hot = digests.groupBy("digest").count().orderBy(F.desc("count")).select(F.xxhash64("digest")).first()[0]
    items = [r["item"] for r in exact_dedup.frequent(digests, 32).collect()]
    assert hot in items and len(items) <= 32
    check([tuple(r) for r in docs.collect()], exact_dedup.report(docs, counters=32))
    _, heavy, light = exact_dedup._split(numbered, 32)
    both = heavy.join(light, "digest", "left_semi").count()
    assert both == 0 and heavy.count() and light.count()


def test_no_python_and_no_text_shuffle(spark, rows):
    plan = exact_dedup.report(spark.createDataFrame(rows, DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


@pytest.mark.parametrize("counters", [exact_dedup.COUNTERS, 32])
def test_keep_returns_the_kept_rows(spark, rows, counters):
    names = ["digest", "keep_rid", "rid", "whole", "known", "group_size", "count", "item", "__rid"]
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit(n).alias(n) for n in names]).repartition(4)
    out = exact_dedup.keep(docs, counters=counters)
    assert out.columns == docs.columns
    got = out.collect()
    groups = brute(rows)
    assert len(got) == len(groups)
    for r in got:
        assert groups[(r["text"] or "").translate(DELETE)][0] == r["doc_id"]
        assert all(r[n] == n for n in names)


def test_empty_table(empty):
    assert exact_dedup.report(empty).count() == 0 and exact_dedup.keep(empty).count() == 0
