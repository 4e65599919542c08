"""Quality rules with robust multivariate outliers, in DataFrame functions.

Base rules fail very short documents and documents that repeat themselves.
For the rest, a vector of transformed statistics is compared with the other
documents of the same language and source: a minimum-covariance-determinant
(MCD) estimate of centre and scatter, and the Mahalanobis distance to it.

MCD by C-steps: from each of two starts (sum and maximum of the coordinates'
z-scores by median and interquartile range) the ``subset`` part of a group with the smallest distances
gives mean and covariance, these give new distances, and so on; the start that
ends with the smaller determinant wins.  One reweighting step follows.  As
most clean documents have no symbols and no repeats at all, the covariance is
regularized by a fixed variance per coordinate (``FLOOR``), which also keeps
the determinant above 0.

Everything per group is an aggregate: approximate percentiles (mergeable) and
moments.  A group below ``MIN_GROUP`` documents takes its language's estimate,
a language below that the estimate over all documents.

Defined cases: a null or empty text has no words and fails the base rules;
null languages and sources are groups of their own; repeated rows are judged
alike; an empty table gives no rows; extra columns pass ``keep`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize, small_join

MIN_WORDS = 10
MAX_REPEAT = 20                 # percent of the words
WINDOW = 5
SYMBOLS = "#*$%&|<>"            # fixed value
SPACES = " \t\n\x0b\x0c\r"      # fixed value

COORDS = ("x_length", "x_word", "x_symbols", "x_lines", "x_repeats")
# standard deviation added per coordinate; the coordinates that have a greatest
# value must reach far beyond CUTOFF on their own: (log(101) / 0.25)^2 = 341,
# (log(101) / 0.50)^2 = 85 and (MAX_REPEAT / 2)^2 = 100
FLOOR = (0.30, 0.15, 0.25, 0.50, 2.00)
MIN_GROUP = 100
SUBSET = 0.75
STEPS = 3
# quantiles of the chi-square distribution with 5 degrees of freedom
CHI2_HALF, CHI2_975, CUTOFF = 4.351, 12.833, 35.0       # 35.0: about 0.9999985


def statistics(documents: DataFrame) -> DataFrame:
    """``documents`` with ``n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words``."""
    t = F.coalesce(F.col("text"), F.lit(""))
    solid = F.translate(t, SPACES, "")
    docs = documents.withColumn("__solid", solid) \
        .withColumn("__lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))) \
        .withColumn("__wh", F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
    docs = docs.select(
        *documents.columns, "__wh",
        F.size("__wh").cast("long").alias("n_words"), F.length("__solid").cast("long").alias("word_chars"),
        (F.length("__solid") - F.length(F.translate("__solid", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"))
    last = F.size("__wh") - WINDOW
    window = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get("__wh", i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    docs = docs.withColumn("__win", window).drop("__wh")
    # most texts repeat no window; only the others are sorted
    some = F.size(F.array_distinct("__win")) < F.size("__win")
    pairs = F.when(some, F.sort_array(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    docs = docs.withColumn("__pairs", pairs).drop("__win")
    n = F.size("__pairs")
    same = lambda i, j: F.get("__pairs", i)["h"].eqNullSafe(F.get("__pairs", j)["h"])
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: same(i, i - 1) | same(i, i + 1))
    places = F.when(F.col("__pairs").isNotNull(), F.sort_array(F.transform(at, lambda i: F.get("__pairs", i)["i"])))
    docs = docs.withColumn("__at", places).drop("__pairs")
    covered = F.aggregate(
        F.col("__at"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("long").alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n"),
                              p.cast("long").alias("last")), lambda a: a["n"])
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics; the added constants draw short texts, whose
    shares vary by chance, towards the middle.  The share of repeated words
    ends at ``MAX_REPEAT`` percent, so it stays a plain share: a logarithm
    would bring one repeated line near to the largest share."""
    share = lambda a, b, c: F.log1p(100.0 * F.col(a) / (F.col(b) + c))
    return [F.log1p("n_words").alias(COORDS[0]),
            F.log((F.col("word_chars") + 150.0) / (F.col("n_words") + 30.0)).alias(COORDS[1]),
            share("n_symbols", "word_chars", 100.0).alias(COORDS[2]),
            share("n_dup_lines", "n_lines", 20.0).alias(COORDS[3]),
            (100.0 * F.col("n_repeat_words") / (F.col("n_words") + 100.0)).alias(COORDS[4])]


def _moments() -> list[Column]:
    out = [F.avg(c).alias(f"m{i}") for i, c in enumerate(COORDS)]
    for i in range(len(COORDS)):
        for j in range(i + 1):
            out.append(F.covar_pop(COORDS[i], COORDS[j]).alias(f"s{i}{j}"))
    return out


def _cholesky(est: DataFrame) -> DataFrame:
    """Adds the Cholesky factor ``l<i><j>`` of the regularized scatter and its
    log-determinant to rows with ``m<i>`` and ``s<i><j>``."""
    for i in range(len(COORDS)):
        for j in range(i + 1):
            s = F.col(f"s{i}{j}") + (FLOOR[i] ** 2 if i == j else 0.0)
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, len(COORDS))), F.log(F.col("l00")))
    return est.withColumn("logdet", 2 * det)


def _distance(rows: DataFrame) -> DataFrame:
    """``d2``: squared Mahalanobis distance by forward substitution."""
    z, total = [], F.lit(0.0)
    for i, c in enumerate(COORDS):
        v = F.col(c) - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"l{i}{k}") * F.col(f"__z{k}")
        rows = rows.withColumn(f"__z{i}", v / F.col(f"l{i}{i}"))
        total = total + F.col(f"__z{i}") * F.col(f"__z{i}")
        z.append(f"__z{i}")
    est = [f"m{i}" for i in range(len(COORDS))] + [f"{p}{i}{j}" for p in "sl" for i in range(len(COORDS)) for j in range(i + 1)]
    return rows.withColumn("d2", total).drop(*z, *est)


def _quantile(column: str, p: float) -> Column:
    return F.percentile_approx(column, F.lit(p), F.lit(10000))


def _grouped(stats: DataFrame) -> DataFrame:
    """Adds ``level`` (0: language and source, 1: language, 2: all) and the
    group's columns ``g_lang``, ``g_source`` (null above the level)."""
    n = materialize(stats.groupBy("lang", "source").count(), "mcd-groups")
    by_lang = n.groupBy("lang").agg(F.sum("count").alias("n_lang")).withColumnRenamed("lang", "__l")
    level = F.when(F.col("count") >= MIN_GROUP, 0).when(F.col("n_lang") >= MIN_GROUP, 1).otherwise(2)
    n = materialize(n.join(by_lang, n["lang"].eqNullSafe(by_lang["__l"])).select("lang", "source", level.alias("level")),
                    "mcd-levels")
    return small_join(stats, n, ["lang", "source"])


def _fit_rows(stats: DataFrame) -> DataFrame:
    """Each document once for every level that some group needs (its own group,
    its language, all), as rows to estimate from."""
    levels = [r[0] for r in stats.select("level").distinct().collect()]
    parts = []
    for lv in sorted(levels):
        lang = F.col("lang") if lv < 2 else F.lit(None).cast("string")
        source = F.col("source") if lv < 1 else F.lit(None).cast("string")
        rows = stats.filter(F.col("level") == 0) if lv == 0 else stats
        parts.append(rows.select(F.lit(lv).alias("level"), lang.alias("g_lang"), source.alias("g_source"), *COORDS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


GROUP = ["level", "g_lang", "g_source"]


def estimates(rows: DataFrame) -> DataFrame:
    """MCD centre, Cholesky factor and distance scale per group of ``rows``."""
    mid = materialize(rows.groupBy(*GROUP).agg(
        *[F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000)).alias(f"q{i}")
          for i, c in enumerate(COORDS)]), "mcd-mid")
    n = mid.count()
    # the interquartile range of a normal variable is 1.349 standard deviations
    z = [(F.col(c) - F.col(f"q{i}")[1]) ** 2 / (((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 + FLOOR[i] ** 2)
         for i, c in enumerate(COORDS)]
    start = small_join(rows, mid, GROUP, rows=n).select(
        *GROUP, *COORDS, F.explode(F.array(
            F.struct(F.lit(0).alias("start"), sum(z[1:], z[0]).alias("d2")),
            F.struct(F.lit(1).alias("start"), F.greatest(*z).alias("d2")))).alias("s"))
    now = start.select(*GROUP, *COORDS, "s.start", "s.d2")
    keys = [*GROUP, "start"]
    twice = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(STEPS):
        cut = materialize(now.groupBy(*keys).agg(_quantile("d2", SUBSET).alias("cut")), "mcd-cut")
        inner = small_join(now, cut, keys, rows=2 * n).filter("d2 <= cut")
        est = materialize(_cholesky(inner.groupBy(*keys).agg(*_moments())), "mcd-step")
        now = _distance(small_join(twice, est.drop("logdet"), keys, rows=2 * n))
    best = est.groupBy(*GROUP).agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    best = materialize(small_join(est, best, keys, rows=n), "mcd-raw")
    # reweighting: all documents within the 0.975 quantile, by scaled distance
    now = _distance(small_join(rows, best.drop("start", "logdet"), GROUP, rows=n))
    scale = materialize(now.groupBy(*GROUP).agg((_quantile("d2", 0.5) / CHI2_HALF).alias("scale")), "mcd-scale")
    inner = small_join(now, scale, GROUP, rows=n).filter(F.col("d2") <= CHI2_975 * F.greatest("scale", F.lit(1e-9)))
    est = materialize(_cholesky(inner.groupBy(*GROUP).agg(*_moments())).drop("logdet"), "mcd-final")
    return est


def judge(documents: DataFrame) -> DataFrame:
    """Per document the statistics, ``base_failed``, ``d2`` and ``kept``."""
    cols = ["doc_id", "lang", "source"]
    keep = [c for c in documents.columns if c == "__key"]
    stats = statistics(documents.select(*cols, "text", *keep)).withColumn("base_failed", base_failed())
    stats = materialize(stats.select(*cols, *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                                     "n_repeat_words", "base_failed", *vector()), "mcd-stats")
    stats = _grouped(stats)
    lang = F.when(F.col("level") < 2, F.col("lang"))
    source = F.when(F.col("level") < 1, F.col("source"))
    stats = stats.withColumn("g_lang", lang).withColumn("g_source", source)
    if stats.limit(1).count() == 0:
        return stats.select(*cols, *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                            "base_failed", F.lit(0.0).alias("d2"), F.lit(True).alias("kept"))
    est = estimates(_fit_rows(stats))
    out = _distance(small_join(stats, est, GROUP))
    kept = ~F.col("base_failed") & (F.col("d2") <= CUTOFF)
    return out.select(*cols, *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "d2", kept.alias("kept"))


def keep(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"), F.col("lang"), F.col("source"))
    keyed = documents.withColumn("__key", key)
    verdict = judge(keyed).filter("kept").select("__key", F.lit(1).alias("__one"))
    return keyed.join(verdict.dropDuplicates(["__key"]), "__key", "left_semi").select(*documents.columns)
