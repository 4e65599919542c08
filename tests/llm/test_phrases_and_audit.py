"""Collocations and the source audit against brute force, perfect hashes alone."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.llm import collocations, divergence, perfect_hash
from tidepool.llm.words import Words, text_blocks

from .conftest import DOCS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def rows(odd_docs):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Élan", "ÉLAN", "der", "Die", "naïve", "x" * 90, "x" * 90 + "y", "日本語"]
    glue = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "-", "; ", "\x0b"]
    out = list(odd_docs)
    for i in range(160):
        text = "".join(vocabulary[min(int(rng.expovariate(0.12)), len(vocabulary) - 1)] + rng.choice(glue)
                       for _ in range(rng.randrange(0, 60)))
        if i % 3 == 0:
            text += " Strong Tea w1 w2 w3 strong tea, "
        out.append((1000 + i, text, ["en", "en", "de", None][i % 4], rng.choice(["a", "a", "a", "b", "c", None]), 1))
    return out + [(1000, "w1 w2 w1 w2 w1 w2", "en", "a", 1)] * 2 + [(2000, "... 12 --", "it", "z", 1), (2001, "", "it", "y", 1)]


def brute_phrases(rows, min_count, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        longer = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], a)
        rows_ = []
        for p, a in found.items():
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            if longer[p] < a:
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("shard_words,limit", [(150, 1 << 20), (10 ** 9, 1 << 20), (1000, 3000), (1000, 10)])
def test_collocations_equal_brute_force(spark, rows, shard_words, limit):
    """Many shards, one shard per task, and both ways past the broadcast limit."""
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = collocations.collocations(docs, min_count=6, top=40, shard_words=shard_words, limit=limit)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 6, 40)


def test_a_frequent_phrase_is_frequent_in_some_shard():
    """Local supports add up to less than the global one: no phrase is lost."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        x = rng.integers(-1, 6, 400)
        cuts = np.sort(rng.integers(1, 400, 4))
        shards = np.split(x, cuts)
        held = [int((s >= 0).sum()) for s in shards]
        total, found = sum(held), set()
        for s, h in zip(shards, held):
            if len(s) and h:
                need = np.array([max(1, -(-30 * h // total))])
                for ids, count, support in collocations.mine(s, need, lambda ids: np.zeros(len(ids), int), 4):
                    assert (count >= support).all()
                    found.update(map(tuple, ids))
        whole = Counter()
        for s in shards:
            for k in range(2, 5):
                whole.update(tuple(s[i:i + k]) for i in range(len(s) - k + 1) if (s[i:i + k] >= 0).all())
        assert {p for p, c in whole.items() if c >= 30} <= found


def test_decimals_do_not_overflow(spark):
    """Products beyond 64 bits stay exact."""
    big = 3_000_000_000_000
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 2)],
                                   "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", 7 * big)], "lang string, n long")
    row = collocations.score(counts, totals).first()
    assert row["score"] == 1000 * (big - 2) * 7 * big // (big * (big - 1))


def brute_audit(rows, min_docs, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []

    def share(c, n, v):
        return 1 + 10 ** 9 * (c + 5) // (n + 5 * v)
    for lang, sources in groups.items():
        kept = [t for t, c in docs[lang].items() if c >= min_docs]
        v = len(kept)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], total[s], v) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(total.values()), v) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for name, part in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, name, item.decode(), -value, rank) for rank, (value, item) in enumerate(part, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_words,limit,held", [(1 << 16, 1 << 20, 1 << 20), (8, 1, 60)])
def test_audit_equals_brute_force(spark, rows, monkeypatch, shard_words, limit, held):
    """One broadcast, and a pass per shard with slots sent on early."""
    monkeypatch.setattr(perfect_hash, "SHARD_WORDS", shard_words)
    plain = divergence.recount
    monkeypatch.setattr(divergence, "recount", lambda d, x, n: plain(d, x, n, held))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = divergence.audit(docs, min_docs=5, top=7, limit=limit)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 5, 7)


def test_audit_in_tiles_and_blocks(spark, rows, monkeypatch):
    plain = divergence._distances
    monkeypatch.setattr(divergence, "_distances", lambda g, s: plain(g, s, 2, 7))
    docs = spark.createDataFrame(rows, DOCS).repartition(2)
    got = divergence.audit(docs, min_docs=3, top=5)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 3, 5)


def test_audit_without_kept_terms(spark, rows):
    got = divergence.audit(spark.createDataFrame(rows, DOCS), min_docs=10 ** 6)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 10 ** 6, 50)


def test_share_is_exact_for_large_counts(spark):
    n = 8 * 10 ** 15
    got = spark.range(1).select(divergence.share(F.lit(n // 3), F.lit(n), F.lit(1000))).first()[0]
    assert got == 1 + 10 ** 9 * (n // 3 + 5) // (n + 5000)


def test_empty_tables_and_foreign_columns(spark, empty, rows):
    assert collocations.collocations(empty).count() == 0 and divergence.audit(empty).count() == 0
    names = ["word", "phrase", "count", "k", "f", "n", "slot", "shard", "value", "rank", "place", "total", "gain", "w"]
    crowded = spark.createDataFrame(rows[:60], DOCS).select("*", *[F.lit(n).alias(n) for n in names])
    assert sorted(map(tuple, collocations.collocations(crowded, min_count=5).collect())) == brute_phrases(rows[:60], 5, 2000)
    assert sorted(map(tuple, divergence.audit(crowded, min_docs=4).collect())) == brute_audit(rows[:60], 4, 50)


def _words(texts):
    return [Words(data, offsets) for _, _, data, offsets in text_blocks(pa.array(texts))][0]


@pytest.mark.parametrize("bits", [64, 6, 0])
def test_perfect_hash_is_minimal_and_verified(monkeypatch, bits):
    """Also with hashes cut to 6 or no bits: equal hashes are told apart."""
    full = Words._hash
    monkeypatch.setattr(Words, "_hash", lambda self: full(self) >> np.uint64(64 - bits) if bits else full(self) * np.uint64(0))
    known = [f"k{i}" for i in range(300)] + ["z" * 80 + str(i) for i in range(5)]
    hashes = perfect_hash._hash_column(pa.array(known))[0].hash
    shards = perfect_hash._shard(hashes, 3)
    lines, base = [], 0
    for s in range(3):
        part = [w for w, x in zip(known, shards) if x == s]
        if part:
            lines.append(perfect_hash.shard_row("en", s, 3, pa.array(part)) | {"base": base})
            base += len(part)
    lexicon = perfect_hash.load(lines)["en"]
    assert sorted(lexicon.lookup(_words(known))) == list(range(len(known)))
    assert (lexicon.lookup(_words([w + "!" for w in known] + ["k", "kk1", "z" * 81])) == -1).all()
    number, first = perfect_hash.numbered(_words(known + known[::-1]))
    assert len(first) == len(known) and (number[:len(known)] == number[len(known):][::-1]).all()
