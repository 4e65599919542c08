"""Quality classifier: supervised subword embeddings.

A text's features are hashed into buckets: its words, the byte n-grams of
words with their boundary (``GRAMS``), and for each run of three words whether
the text had it before; a repeated run gives that feature only, not its first
word's words and n-grams once more.  Every bucket has a learned vector; a document is the
average of its features' vectors and a softmax layer turns that into class
probabilities.  Vectors and layer are learned together by stochastic gradient
descent in numpy, with steps scaled per bucket (Adagrad), on a bounded sample
of labelled documents: the ``TRAIN_ROWS`` smallest hashes of their ids.

As the layer is linear, a bucket's vector adds a fixed amount to the logit.
Scoring so needs one number per bucket (``BUCKETS`` floats, sent to every
task) and passes over the whole text once, in blocks of bounded size.

Defined cases: null and empty texts have no features and get the score of the
learned bias; null and other labels than 0 and 1 are not learned from; without
any labelled row every score is 0.5; repeated rows are scored alike; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, mix, text_blocks

BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
RUN = 3                          # words of a run that is looked up for repeats
EPOCHS = 6
RATE = 0.3
TRAIN_ROWS = 6000
SEED = 7
NEW, AGAIN = 0, 1                # buckets kept for runs of words

_MASK = {n: np.uint64((1 << (8 * n)) - 1) for n in GRAMS}


def _bucket(h: np.ndarray) -> np.ndarray:
    return 2 + (mix(h) % np.uint64(BUCKETS - 2)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a block's features: ``(bucket, valid, row bounds)``; a row's
    features stand between its two bounds."""
    words = Words(data, offsets)
    h, inside = words.grams(RUN)
    again = np.zeros(len(words.hash), dtype=np.int64)
    if len(h):
        key = mix(h + words.doc[:len(h)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        again[order[1:][key[order[1:]] == key[order[:-1]]]] = AGAIN
    again[:len(h)][~inside] = NEW
    fresh = again != AGAIN
    yield _bucket(words.hash), fresh, words.first
    valid = np.zeros(len(words.hash), dtype=bool)
    valid[:len(h)] = inside
    yield again, valid, words.first
    n = len(data)
    solid = np.ones(n, dtype=bool)
    solid[words.data <= 0x20] = False
    text = np.where(solid, words.data, np.uint8(0x20))
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    chunk = np.ndarray(n, dtype="<u8", buffer=padded.data, strides=(1,)) if n else np.zeros(0, "<u8")
    inner = np.ones(n, dtype=bool)
    if not fresh.all():                                 # a repeated run counts as a repeat only
        edge = np.zeros(n + 1, dtype=np.int8)
        edge[words.start[~fresh]] += 1
        edge[words.end[~fresh]] -= 1
        inner = np.cumsum(edge[:n], dtype=np.int8) == 0
    for size in range(3, max(GRAMS) + 1):
        step = size - 2                                 # bytes 1 .. size - 2 must be in a word
        inner[:max(0, n - step)] &= solid[step:]
        if size not in GRAMS:
            continue
        valid = inner.copy()
        for back in range(1, size):                     # a gram ends within its row
            at = offsets[1:] - back
            valid[at[(at >= 0) & (at >= offsets[:-1])]] = False
        yield _bucket((chunk & _MASK[size]) * np.uint64(8) + np.uint64(size)), valid, offsets


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums between neighbouring bounds; each depends on its own values only."""
    full = bounds[1:] > bounds[:-1]
    out = np.zeros(len(bounds) - 1)
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out


def sparse(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row its buckets and their share of the row's features."""
    parts = [[] for _ in range(len(offsets) - 1)]
    for bucket, valid, bounds in features(data, offsets):
        for i, rows in enumerate(parts):
            a, b = bounds[i], bounds[i + 1]
            rows.append(bucket[a:b][valid[a:b]])
    out = []
    for rows in parts:
        b, n = np.unique(np.concatenate(rows), return_counts=True)
        out.append((b.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
          seed: int = SEED) -> tuple[np.ndarray, float]:
    """Learned amount per bucket and bias of the logit for label 1."""
    if not len(rows):
        return np.zeros(BUCKETS, np.float32), 0.0
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = rng.uniform(-1, 1, (DIM, 2)), np.zeros(2)
    seen, seen_layer, seen_bias = np.full(BUCKETS, 1e-8), np.full((DIM, 2), 1e-4), np.full(2, 1e-2)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            bucket, share = rows[i]
            hidden = share @ vectors[bucket]
            logit = hidden @ layer + bias
            p = np.exp(logit - logit.max())
            wrong = p / p.sum()
            wrong[labels[i]] -= 1
            back = layer @ wrong
            step = np.outer(hidden, wrong)
            seen_layer += step * step
            layer -= RATE * step / np.sqrt(seen_layer)
            seen_bias += wrong * wrong
            bias -= RATE * wrong / np.sqrt(seen_bias)
            seen[bucket] += share * share * (back @ back)
            vectors[bucket] -= (RATE * share / np.sqrt(seen[bucket]))[:, None] * back
    direction = layer[:, 1] - layer[:, 0]
    return (vectors @ direction).astype(np.float32), float(bias[1] - bias[0])


def score_block(data: np.ndarray, offsets: np.ndarray, amount: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for bucket, valid, bounds in features(data, offsets):
        total += row_sums(np.where(valid, amount[bucket], np.float32(0)).astype(np.float64), bounds)
        count += row_sums(valid.astype(np.float64), bounds)
    logit = bias + total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = TRAIN_ROWS):
    """Trains on at most ``max_rows`` labelled documents outside the held-out
    third and returns ``(amount per bucket, bias)``."""
    sample = labels.filter(F.col(label).isin(0, 1) & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)           # its size is max_rows at most

    def extract(batches):
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch["text"]):
                rows = sparse(data, offsets)
                yield pa.record_batch([batch["doc_id"].slice(a, b - a), batch["label"].slice(a, b - a),
                                       pa.array([r[0].tobytes() for r in rows], pa.binary()),
                                       pa.array([r[1].tobytes() for r in rows], pa.binary())],
                                      names=["doc_id", "label", "bucket", "share"])

    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text") \
        .mapInArrow(extract, "doc_id long, label int, bucket binary, share binary")
    got = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["bucket"]))
    x = [(np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["share"], np.float32)) for r in got]
    return train(x, np.array([r["label"] for r in got], dtype=int))


def score(documents: DataFrame, model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        amount, bias = sent.value
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch["text"]):
                s = score_block(data, offsets, amount, bias)
                yield pa.record_batch([batch["doc_id"].slice(a, b - a), batch["held_out"].slice(a, b - a), pa.array(s)],
                                      names=["doc_id", "held_out", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double") \
               .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    return score(documents, fit(documents, labels, label))
