"""Mixing sources to target weights: capped water-filling.

Every source gets its weight's part of the wanted total.  A source whose part
exceeds ``max_epochs`` times its size is clamped there and its excess is
shared among the others by weight, until none is above.  A source's target is
then met by whole repetitions of every document plus one more repetition of
seeded-random documents, the last of them in part, so the words taken equal
the target rounded.

Only DataFrame functions run here.  Per-source and per-bucket tables are
aggregates; no window holds a source: a document's place in its source's
random order comes from prefix sums over the first digits of its digest, and
rows are ordered only inside the one bucket where the target ends.

Defined cases: a null text has no words, null sources are one source (last in
order), repeated rows count each, an empty table gives no rows, a source
without words has target 0.  Extra columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, small_join, word_count

WEIGHTS = (3, 1, 2)             # by source order, repeating
SHARE = (3, 2)                  # the mix holds 3/2 of all words
MAX_EPOCHS = 2
SEED = 17
DIGITS = 3                      # hex digits of a bucket level: 4096 buckets


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, size)`` rows.

    One row per source; the clamping loop runs over that table only and ends
    after as many rounds as there are clampings that free new excess.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")       # one row per source
    n = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (n + 1).cast("int"))
    per = materialize(per.withColumn("weight", weight.cast("long"))
                         .withColumn("cap", (F.col("source_size") * max_epochs).cast("long")), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    wanted, parts = total * share[0], share[1]                        # integers: nothing is rounded early
    clamped, rest, weight_sum = -1, wanted, 0
    over = F.lit(False)
    while True:
        row = per.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("cap"))),
                      F.sum(F.when(~over, F.col("weight")))).first()
        if row[0] == clamped:
            break
        clamped, rest, weight_sum = row[0], wanted - parts * (row[1] or 0), row[2] or 0
        if not weight_sum:
            break
        # a source is above its cap when weight * rest / (parts * weight_sum) > cap
        over = over | (F.col("weight") * F.lit(rest).cast("decimal(38,0)")
                       > F.col("cap") * F.lit(parts * weight_sum).cast("decimal(38,0)"))
    part = (F.col("weight") * F.lit(float(rest))) / F.lit(float(max(1, parts * weight_sum)))
    return per.select("source", "source_size", "weight",
                      F.when(over, F.col("cap").cast("double")).otherwise(part).alias("target"))


def _digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def plan(sizes: DataFrame, per_source: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``taken`` to ``(doc_id, source,
    size)`` rows (give a written table)."""
    need = per_source.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
         .cast("long").alias("whole")) \
        .withColumn("extra", F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("source_size"))
    need = materialize(need, "mix-need")
    h = _digest(F.col("doc_id"), seed)
    docs = sizes.withColumn("__b1", F.substring(h, 1, DIGITS)) \
                .withColumn("__b2", F.substring(h, 1 + DIGITS, DIGITS)) \
                .withColumn("__h", h)
    # level 1: whole buckets below the target's end are taken, one bucket is open
    open1 = _open_bucket(docs, need, ["__b1"])
    docs1 = small_join(docs, open1, ["source"], "left")
    at1 = F.when(F.col("__b1") == F.col("__open"), 0).when(F.col("__b1") < F.col("__open"), 1).otherwise(-1)
    docs1 = docs1.withColumn("__side", F.coalesce(at1, F.lit(-1)))
    # level 2 inside the open bucket, then an exact order inside the last one
    inner = materialize(docs1.filter("__side = 0").select("doc_id", "source", "size", "__b2", "__h", "__left"),
                        "mix-open")
    open2 = _open_bucket(inner.drop("__left"), open1.select("source", F.col("__left").alias("extra")), ["__b2"])
    inner2 = small_join(inner.drop("__left"), open2, ["source"], "left")
    at2 = F.when(F.col("__b2") == F.col("__open"), 0).when(F.col("__b2") < F.col("__open"), 1).otherwise(-1)
    inner2 = inner2.withColumn("__side", F.coalesce(at2, F.lit(-1)))
    last = Window.partitionBy("source").orderBy("__h", "doc_id", "size") \
                 .rowsBetween(Window.unboundedPreceding, -1)
    exact = inner2.filter("__side = 0").withColumn("__before", F.coalesce(F.sum("size").over(last), F.lit(0))) \
        .withColumn("__more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("__left") - F.col("__before"))))
    cols = ["doc_id", "source", "size", "__more"]
    done = docs1.filter("__side <> 0").withColumn(
        "__more", F.when(F.col("__side") == 1, F.col("size")).otherwise(0)).select(cols)
    done = done.unionByName(inner2.filter("__side <> 0").withColumn(
        "__more", F.when(F.col("__side") == 1, F.col("size")).otherwise(0)).select(cols))
    done = done.unionByName(exact.select(cols))
    return small_join(done, need, ["source"]).select(
        "doc_id", "source", "size", "source_size", "target", "whole", F.col("__more").cast("long").alias("more"),
        (F.col("whole") * F.col("size") + F.col("__more")).cast("long").alias("taken"))


def _open_bucket(docs: DataFrame, need: DataFrame, bucket: list[str]) -> DataFrame:
    """Per source the bucket in which its ``extra`` words end, and how many
    words are left for it (``__left``)."""
    b = bucket[0]
    per = docs.groupBy("source", b).agg(F.sum("size").alias("__s"))
    before = Window.partitionBy("source").orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__before", F.coalesce(F.sum("__s").over(before), F.lit(0)))
    per = small_join(per, need.select("source", "extra"), ["source"])
    hit = per.filter((F.col("__before") < F.col("extra")) & (F.col("extra") <= F.col("__before") + F.col("__s")))
    # the smallest matching bucket (a bucket of size 0 never matches)
    return materialize(hit.select("source", F.col(b).alias("__open"),
                                  (F.col("extra") - F.col("__before")).alias("__left")), "mix-open-buckets")


def sizes_of(documents: DataFrame) -> DataFrame:
    return materialize(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")


def mix_report(documents: DataFrame, seed: int = SEED, **kw) -> DataFrame:
    """Per document the words that the mix takes: ``doc_id, size, source_size,
    target, taken`` and the number of ``whole`` repetitions and further words
    (``more``)."""
    sizes = sizes_of(documents)
    return plan(sizes, targets(sizes, **kw), seed).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "whole", "more")


def mix(documents: DataFrame, seed: int = SEED, **kw) -> DataFrame:
    """The mixed rows: each document as often as it is repeated, with the same
    columns.  A repetition in part holds the text's first ``more`` words, joined
    by one space.  Documents that the mix does not take are not returned."""
    cols = documents.columns
    docs = documents.withColumn("__key", F.xxhash64(*[F.col(c) for c in cols]))
    sizes = materialize(docs.select(F.col("__key").alias("doc_id"), "source", word_count(F.col("text")).alias("size")),
                        "mix-sizes")
    taken = plan(sizes, targets(sizes, **kw), seed)
    # equal rows are interchangeable: the n-th of them takes the n-th plan
    taken = taken.groupBy(F.col("doc_id").alias("__k")).agg(
        F.sort_array(F.collect_list(F.struct("taken", "whole", "more", "size")), asc=False).alias("__plans"))
    same = Window.partitionBy("__key").orderBy("doc_id")
    rows = docs.withColumn("__n", F.row_number().over(same))         # partitioned as the join needs it
    rows = rows.join(taken, rows["__key"] == taken["__k"]).withColumn("__plan", F.element_at("__plans", F.col("__n")))
    rows = rows.select(*cols, F.col("__plan.whole").alias("__whole"), F.col("__plan.more").alias("__more"),
                       F.col("__plan.size").alias("__size"))
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1,
                                       F.greatest(F.col("__more"), F.lit(1)).cast("int")), " ")
    copies = F.concat(F.array_repeat(F.lit(-1), F.col("__whole").cast("int")),
                      F.when(F.col("__more") > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("__copy", F.explode(copies))
    part = (F.col("__copy") == 0) & (F.col("__more") < F.col("__size"))
    rows = rows.withColumn("text", F.when(part, first_words).otherwise(F.col("text")))
    return rows.select(*cols)
