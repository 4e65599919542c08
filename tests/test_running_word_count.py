"""Running counts of words from blocks of texts: no token is shuffled."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.operators import rolling, texts

COLS = ["doc_id", "line_no", "token_pos", "word", "count"]


def _plain(docs):
    """The direct form: one running count over all tokens."""
    toks = texts.tokens(docs, ["doc_id"], "text")
    return rows(rolling.rolling_count(toks, ["word"], ["doc_id", "line_no", "token_pos"]), *COLS)


def _docs(spark, kind="bigint"):
    r = random.Random(5)
    ids = [None, None, None, 7, 7, *range(20, 60), 60, 60, 60]
    made = []
    for i in ids:
        text = "\n".join(r.choice(["", "   ", " x", "a  b "]) + " ".join(r.choice(["a", "b", "été", "c", "|"])
                         for _ in range(r.randrange(12))) for _ in range(r.randrange(5)))
        made.append((i if i is None or kind == "bigint" else f"document-{i:05}", text))
    made += [(None, None), (made[3][0], None), (made[5][0], "")]
    r.shuffle(made)
    return spark.createDataFrame(made, f"doc_id {kind}, text string").repartition(5)


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("size", [8 << 20, 300, 40, 1])
def test_blocks_of_all_sizes(spark, monkeypatch, kind, size):
    monkeypatch.setattr(texts, "BLOCK_BYTES", size)
    monkeypatch.setattr(texts, "BATCH_TOKENS", 7)
    docs = _docs(spark, kind)
    assert rows(texts.running_word_count(docs, "doc_id", "text"), *COLS) == _plain(docs)


def test_blocks_rise_with_the_id(spark, monkeypatch):
    monkeypatch.setattr(texts, "BLOCK_BYTES", 25)
    docs = _docs(spark).where("text is not null")
    placed, alone = texts.text_blocks(docs, "doc_id", "text")
    per_id = placed.groupBy("doc_id").agg(F.count_distinct("_block").alias("n"), F.min("_block").alias("b"),
                                          F.max("_alone").alias("alone"), F.sum(F.octet_length("text") + 1).alias("bytes"),
                                          F.count("*").alias("texts")).collect()
    assert all(r["n"] == 1 and r["alone"] == (r["texts"] > 1 and r["bytes"] > 25) for r in per_id)
    assert alone == sum(r["alone"] for r in per_id) > 0
    blocks = [r["b"] for r in sorted(per_id, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))]
    assert blocks == sorted(blocks) and blocks[0] == 0 and blocks[-1] > 5
    own = [r["b"] for r in per_id if r["alone"]]
    assert all(sum(b == r["b"] for r in per_id) == 1 for b in own)


def test_ids_that_are_not_numbers(spark):
    docs = spark.createDataFrame([(float("nan"), "a b"), (float("nan"), "b a"), (1.0, "a")], "doc_id double, text string")
    got = [t[1:] for t in rows(texts.running_word_count(docs, "doc_id", "text"), *COLS)]
    assert sorted(got) == [(1, 1, "a", 1), (1, 1, "a", 2), (1, 1, "b", 1), (1, 2, "a", 3), (1, 2, "b", 2)]


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert texts.running_word_count(docs, "doc_id", "text").collect() == []


def test_tokens_are_not_shuffled(spark):
    """What is dealt out is texts by block and counts per block, never (id, line, position)."""
    from tidepool.plans import analyses
    docs = _docs(spark)
    plan = analyses.word_count_rolling(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    windows = [w for w in plan.split("\n") if re.search(r"\bWindow \[", w)]
    assert windows and not any("token_pos" in w for w in windows)
    assert not any("token_pos" in w for w in plan.split("\n") if "Sort [" in w or "Exchange hashpartitioning" in w)
