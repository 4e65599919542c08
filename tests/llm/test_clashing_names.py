"""Extra columns with names that the operators use themselves."""

import pytest
from pyspark.sql import functions as F

from tidepool.llm import mixing, ngram_join, packing, quality_rules, sharding, subword_classifier, substring_dedup

NAMES = ["rid", "whole", "more", "n_words", "kept", "level", "count", "size", "label", "shard", "row", "id", "digest",
         "target", "taken", "score", "held_out", "d2", "n"]


@pytest.fixture(scope="module")
def crowded(documents):
    return documents.select("*", *[F.lit(f"mine {n}").alias(n) for n in NAMES])


@pytest.mark.parametrize("stage", [quality_rules.keep, ngram_join.distinct, substring_dedup.remove, mixing.mix])
def test_stages_keep_foreign_columns(crowded, stage):
    out = stage(crowded)
    assert out.columns == crowded.columns
    rows = out.collect()
    assert rows and all(r[n] == f"mine {n}" for r in rows for n in NAMES)


@pytest.mark.parametrize("report", [quality_rules.judge, ngram_join.join, substring_dedup.report, mixing.mix_report,
                                    sharding.shard_documents, packing.pack])
def test_reports_ignore_foreign_columns(crowded, odd_docs, report):
    rows = report(crowded).select("doc_id").distinct().count()
    assert rows == len(odd_docs)


def test_classifier_ignores_foreign_columns(spark, crowded, odd_docs):
    labels = spark.createDataFrame([(r[0], r[0] % 2, "x") for r in odd_docs], "doc_id long, quality int, label string")
    assert subword_classifier.classify(crowded, labels).count() == len(odd_docs)
