"""The registered queries of this subpackage: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (collocations, divergence, exact_dedup, html_wrappers, kdtree, mixing, ngram_join, packing, quality_rules, sharding, substring_dedup,
               subword_classifier, warc)
from .common import table


def op1_substring_dedup(spark, sf):
    return substring_dedup.report(table(spark, sf, "documents"))


def op2_quality_classifier(spark, sf):
    return subword_classifier.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_sharding(spark, sf):
    docs = sharding.shard_documents(table(spark, sf, "documents"))
    return docs.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_source_mix(spark, sf):
    return mixing.mix_report(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row")


def op6_html_extract(spark, sf):
    return html_wrappers.extract(table(spark, sf, "pages"))


def op7_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op8_warc_archive(spark, sf):
    path = warc.write(table(spark, sf, "pages"), warc.fresh_path(spark))
    return warc.index(spark, path)


def op9_topk_search(spark, sf):
    vectors = kdtree.quantised(table(spark, sf, "embeddings"))
    return kdtree.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op10_ngram_jaccard(spark, sf):
    return ngram_join.join(table(spark, sf, "documents"))


def op11_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


def op12_source_audit(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


def op13_exact_dedup(spark, sf):
    return exact_dedup.report(table(spark, sf, "documents")).drop("rid")


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_quality_classifier, op3_sharding, op4_source_mix, op5_packing, op6_html_extract,
                                   op7_quality_rules, op8_warc_archive, op9_topk_search, op10_ngram_jaccard,
                                   op11_collocations, op12_source_audit, op13_exact_dedup)}
