import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.llm import kdtree, mixing, packing, quality_rules, sharding, subword_classifier, warc
from tidepool.llm.common import table
from tidepool.llm.words import Words, text_blocks

from .conftest import DOCS, words

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------- words

def test_words_equal_the_regular_expression(odd_docs):
    import pyarrow as pa
    texts = [r[1] for r in odd_docs] + ["a b c", "x\x1cy", "é è", "a" * 70 + " " + "a" * 70]
    seen = {}
    for a, b, data, offsets in text_blocks(pa.array(texts, pa.string()), 100):
        w = Words(data, offsets)
        for i in range(b - a):
            lo, hi = w.first[i], w.first[i + 1]
            got = [bytes(data[s:e]).decode() for s, e in zip(w.start[lo:hi], w.end[lo:hi])]
            assert got == words(texts[a + i])
            for word, h in zip(got, w.hash[lo:hi]):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# ------------------------------------------------------------------ mixing

def waterfill(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(w[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and w[s] * rest / free > cap * sizes[s]} if free else set()
        if not over:
            return {s: cap * sizes[s] if s in full else w[s] * rest / free for s in sizes}
        full |= over


def test_mix_meets_the_targets(documents, odd_docs):
    sizes = defaultdict(int)
    for r in odd_docs:
        sizes[r[3]] += len(words(r[1]))
    want, taken = waterfill(sizes), defaultdict(int)
    rows = mixing.mix_report(documents).collect()
    assert len(rows) == len(odd_docs)
    source = {r[0]: r[3] for r in odd_docs}
    for r in rows:
        assert r["size"] == len(words(next(d[1] for d in odd_docs if d[0] == r["doc_id"])))
        assert abs(r["target"] - want[source[r["doc_id"]]]) < 1e-6 and r["source_size"] == sizes[source[r["doc_id"]]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5
    again = mixing.mix_report(documents.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_returns_the_repetitions(documents, odd_docs):
    out = mixing.mix(documents)
    assert out.columns == documents.columns
    n = sum(len(words(r["text"])) for r in out.collect())
    assert abs(n - sum(waterfill(_sizes(odd_docs)).values())) <= len(_sizes(odd_docs))


def _sizes(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[3]] += len(words(r[1]))
    return out


def test_mix_of_equal_rows_and_empty_tables(spark, empty):
    rows = [(1, "a b c", "en", "s", 1)] * 3 + [(None, "d e", "en", "s", 1)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS))
    # 11 words are there, 16.5 are wanted
    assert sum(len(words(r["text"])) for r in out.collect()) in (16, 17)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0


# ---------------------------------------------------------------- sharding

def test_sharding(documents, odd_docs):
    rows = sharding.shard_documents(documents, 4).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in odd_docs)
    text = {r[0]: (r[1] or "").encode() for r in odd_docs}
    of, slots, load = {}, defaultdict(list), Counter()
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]]) + 8
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        assert of.setdefault(text[r["doc_id"]], r["shard"]) == r["shard"]        # equal texts stay together
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(of.values()) <= set(range(4))


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing_equals_group_by_group(seed):
    rng = np.random.default_rng(seed)
    sizes = sorted((int(s) for s in rng.integers(1, 60, 300)), reverse=True)
    capacity, free, want = 100, [], []
    for s in sizes:                                   # one group at a time
        fits = [(f, i) for i, f in enumerate(free) if f >= s]
        if fits:
            f, i = min(fits, key=lambda x: (x[0], -x[1]))
        else:
            free.append(capacity)
            i = len(free) - 1
        free[i] -= s
        want.append((s, i))
    histogram = sorted(Counter(sizes).items(), reverse=True)
    runs, bins = sharding.pack(histogram, capacity)
    got = Counter((s, b) for s, a, e, b in runs for _ in range(e - a))
    loads = Counter()
    for (s, b), n in got.items():
        loads[b] += s * n
    assert bins == len(free) and max(loads.values()) <= capacity
    assert sorted(loads.values()) == sorted(capacity - f for f in free)
    assert sum(got.values()) == len(want)


def test_even_shards_and_oversized_groups():
    runs = sharding.fit([(50, 1), (10, 3), (3, 20), (1, 30)], 4)
    load = Counter()
    for s, a, e, b in runs:
        load[b] += s * (e - a)
    assert load[0] == 50 and sorted(load.values())[:3] == [40, 40, 40]


def test_sharding_of_odd_tables(spark):
    """Repeated rows and rows without a doc_id are put once each; an empty
    table gives no rows."""
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (None, None), (2, ""), (None, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(t or "") + 8) for d, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= k < 24 for k in slots)
    assert sharding.shard_documents(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- packing

def test_packing_round_trip(documents, odd_docs):
    encode = packing.Encoder(packing.default_tokenizer())
    rows = packing.pack(documents, shard_rows=20, with_ids=True).collect()
    ids = {r[0]: encode.slow.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in odd_docs}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for doc, want in ids.items():
        got = []
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            piece = np.frombuffer(r["ids"], np.uint32)
            assert r["start"] == len(got) and r["length"] == len(piece) and r["doc_tokens"] == len(want)
            assert r["ids_crc32"] == zlib.crc32(piece.astype("<u4").tobytes())
            got += piece.tolist()
        assert got == want
    short = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        short += at < 1024
    assert short <= -(-len(odd_docs) // 20) + 1        # only a shard's last window


def test_fast_encoder_equals_tokenizers():
    encode = packing.Encoder(packing.default_tokenizer())
    assert encode.fast is not None
    for text in ["", " ", "a b\nc d\n", " a", "a ", "a\u00a0b \u2003c", "a  b\n\n c\t", "don't  I'll", "日本語 テキスト", "é   x", "<|endoftext|>", "z" * 25000,
                 " ".join(chr(c) for c in range(0x21, 0x600)), "١٢٣ ½ ²³ 🙂🙃", "\r\n \x0b\x0c"]:
        assert encode(text).tolist() == encode.slow.encode(text, add_special_tokens=False).ids


def test_term_counts():
    for ids in ([], [5], [3, 3, 1, 70000, 1], [2, 2, 9]):
        terms, counts = packing.term_counts([np.array(ids, np.uint32)])[0]
        assert dict(zip(terms.tolist(), counts.tolist())) == dict(Counter(ids)) and sorted(terms) == terms.tolist()


def test_scores_equal_a_plain_bm25():
    """All terms of the seed count, frequent or rare, however many documents
    are used already; neighbours come in order of score."""
    rng = np.random.default_rng(5)
    texts = [rng.zipf(1.4, rng.integers(0, 300)).clip(1, 499).astype(np.uint32) for _ in range(300)]
    found = packing.term_counts(texts[:200]) + packing.term_counts(texts[200:])
    assert all(dict(zip(*np.unique(t, return_counts=True))) == dict(zip(*f)) for t, f in zip(texts, found))
    df = np.bincount(np.concatenate([t for t, _ in found]), minlength=500)
    docs, mean = 5000, 140.0
    index = packing.Index([t for t, _ in found], [c for _, c in found], df, docs, mean)
    assert 0 < len(index.dense) < len(np.flatnonzero(df))
    unused = np.ones(300, bool)
    for seed in range(0, 300, 7):
        want = np.zeros(300)
        mine = set(found[seed][0].tolist())
        for d, (terms, counts) in enumerate(found):
            for t, n in zip(terms.tolist(), counts.tolist()):
                if t in mine and d != seed and unused[d]:
                    idf = np.log(1 + (docs - df[t] + 0.5) / (df[t] + 0.5))
                    want[d] += idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * counts.sum() / mean))
        got = index.scores(seed, unused)
        assert np.allclose(got, want, rtol=1e-4, atol=1e-5)
        order = list(index.neighbours(seed, unused))
        assert sorted(order) == np.flatnonzero(want).tolist() and (np.diff(got[order]) <= 0).all()
        unused[rng.choice(300, 12)] = False


def test_neighbours_share_terms():
    terms = [np.array([1, 2], np.uint32), np.array([2, 3], np.uint32), np.array([4], np.uint32), np.array([1, 2], np.uint32)]
    index = packing.Index(terms, [np.ones(len(t), np.uint32) for t in terms], np.bincount([1, 2, 2, 3, 4, 1, 2]), 4, 2.0)
    found = [int(d) for d in index.neighbours(0, np.ones(4, bool))]
    assert found == [3, 1]


def test_neighbours_by_any_shared_term():
    """A document that shares only the lightest of many terms is found too."""
    many = np.arange(40, dtype=np.uint32)
    terms = [many, many[:39], np.array([39, 50], np.uint32), np.array([60], np.uint32)]
    df = np.full(61, 2)
    df[39] = 900
    index = packing.Index(terms, [np.ones(len(t), np.uint32) for t in terms], df, 1000, 20.0)
    assert list(index.neighbours(0, np.ones(4, bool))) == [1, 2]


def planted_pairs(n, pairs, seed=11):
    """``n`` documents of ordinary words; document ``i < pairs`` and document
    ``n - 1 - i`` share three words that few others have."""
    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    single = sorted((w[1:] for w in vocab if w[0] == "\u0120" and w[1:].isascii() and w[1:].isalpha() and len(w) > 6))
    rng = np.random.default_rng(seed)
    single = rng.permutation(single)
    common, rare = single[:300], single[300:]
    texts = [rng.choice(common, 100).tolist() for _ in range(n)]
    for i in range(pairs):
        own = rng.choice(rare, 3, replace=False).tolist()
        texts[i][50:50] = own
        texts[n - 1 - i][20:20] = own
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def neighbours_met(spark, n, pairs, shard_rows):
    """How often the planted neighbour of a seed lands in the seed's window."""
    docs = spark.createDataFrame(planted_pairs(n, pairs), "doc_id long, text string").repartition(4)
    at, seeds = defaultdict(set), {}
    for r in packing.pack(docs, shard_rows=shard_rows).select("doc_id", "sequence_id", "offset").collect():
        at[r["doc_id"]].add(r["sequence_id"])
        if r["offset"] == 0 and r["doc_id"] < pairs:
            seeds[r["doc_id"]] = r["sequence_id"]
    return np.mean([q in at[n - 1 - i] for i, q in seeds.items()])


def test_planted_neighbours_are_met_at_any_size(spark):
    small, large = neighbours_met(spark, 400, 100, 100), neighbours_met(spark, 3200, 800, 100)
    assert small > 0.3 and large > 0.3, (small, large)


def long_and_short(spark, n=300):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 900, 900 if i % 5 == 0 else 20))) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, "")], "doc_id long, text string").repartition(3)


def test_rows_of_the_shuffle_are_small(spark):
    """Two bytes a token, and terms only of documents with full windows."""
    path = packing.default_tokenizer()
    kind = packing.id_type(path)
    assert kind.itemsize == 2
    rows = packing.tokenized(long_and_short(spark), path, kind)
    df, docs, _ = packing.document_frequencies(rows, kind)
    whole = 0
    for r in packing.to_shards(packing.dealt(rows, df, docs, 4, kind), 4).collect():
        full = len(r["full_crc"])
        assert len(r["tail"]) == 2 * (r["n_tokens"] - 1024 * full)
        assert (r["terms"] is None) == (r["counts"] is None) == (full == 0)
        whole += full == 0
        if full:
            assert len(r["counts"]) in (len(r["terms"]) // 2, len(r["terms"]))
    assert 0 < whole < docs


def test_partitions_hold_equal_numbers_of_shards(spark):
    path = packing.default_tokenizer()
    kind = packing.id_type(path)
    rows = packing.tokenized(long_and_short(spark), path, kind)
    df, docs, _ = packing.document_frequencies(rows, kind)
    held = packing.to_shards(packing.dealt(rows, df, docs, 24, kind), 8).groupBy(F.spark_partition_id()).agg(F.countDistinct("shard"))
    assert [n for _, n in held.collect()] == [3] * 8


def test_ids_of_two_or_four_bytes_give_the_same_pieces(spark, monkeypatch):
    docs = long_and_short(spark).localCheckpoint()
    few = packing.pack(docs, length=256, shard_rows=40, with_ids=True).collect()
    monkeypatch.setattr(packing, "id_type", lambda path: np.dtype("<u4"))
    many = packing.pack(docs, length=256, shard_rows=40, with_ids=True).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, many)) and len(few) > 302


def test_id_type_of_a_large_vocabulary(tmp_path):
    from tokenizers import Tokenizer, models
    for n, size in ((1 << 16, 2), ((1 << 16) + 1, 4)):
        Tokenizer(models.WordLevel({f"w{i}": i for i in range(n)}, unk_token="w0")).save(str(tmp_path / "t.json"))
        assert packing.id_type(str(tmp_path / "t.json")).itemsize == size


def test_narrow_counts():
    for counts, size in (([], 0), ([1, 255], 1), ([1, 256], 2), ([7, 1 << 16], 4)):
        kept = packing.narrow(np.array(counts, np.uint32))
        assert len(kept) == size * len(counts) and packing.wide(kept, len(counts)).tolist() == counts


def test_shards_over_batches():
    batches = [pa.record_batch([pa.array(s, pa.int64()), pa.array(v)], names=["shard", "v"])
               for s, v in (([1, 1, 4], [0, 1, 2]), ([4, 4], [3, 4]), ([], pa.array([], pa.int64())), ([4, 6, 9], [5, 6, 7]))]
    assert [(s, t["v"].to_pylist()) for s, t in packing.by_shard(batches)] == [(1, [0, 1]), (4, [2, 3, 4, 5]), (6, [6]), (9, [7])]
    assert list(packing.by_shard([])) == []


def test_tokenizers_is_loaded_when_a_text_needs_it():
    encode = packing.Encoder(packing.default_tokenizer())
    encode("a plain text")
    assert "slow" not in vars(encode)
    assert len(encode("z" * 25000)) and "slow" in vars(encode)
    assert packing.encoder(packing.default_tokenizer()) is packing.encoder(packing.default_tokenizer())


# ----------------------------------------------------------- quality rules

def test_statistics_and_verdicts(documents, odd_docs):
    got = {r["doc_id"]: r for r in quality_rules.judge(documents).collect()}
    assert len(got) == len(odd_docs)
    for r in odd_docs:
        w, t = words(r[1]), r[1] or ""
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        rep = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if words(x)]
        g = got[r[0]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))
        assert g["base_failed"] == (len(w) < 10 or 100 * len(rep) > 20 * len(w))
        assert not (g["base_failed"] and g["kept"])


def test_quality_rules_keep_clean_and_drop_junk(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = quality_rules.judge(docs).select("doc_id", "kept", "base_failed")
    rows = kept.join(labels, "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2
    assert quality_rules.keep(docs).columns == docs.columns


def test_quality_rules_equal_numpy(spark):
    """The estimate of one group against the same steps in numpy."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5))
    x[:40] += 25
    rows = spark.createDataFrame([(0, None, None, *map(float, r)) for r in x],
                                 "level int, g_lang string, g_source string, " + ", ".join(f"{c} double" for c in quality_rules.COORDS))
    est = quality_rules.estimates(rows).first().asDict()
    mean = np.array([est[f"m{i}"] for i in range(5)])
    low = np.array([[est.get(f"l{i}{j}") or 0.0 for j in range(5)] for i in range(5)])
    clean = x[40:]
    assert np.abs(mean - clean.mean(axis=0)).max() < 0.5
    d2 = (np.linalg.solve(low, (x - mean).T) ** 2).sum(axis=0)
    assert d2[:40].min() > quality_rules.CUTOFF > np.quantile(d2[40:], 0.95)


def test_each_coordinate_alone_rejects(spark):
    """One planted document per coordinate among ordinary ones."""
    rng = np.random.default_rng(5)

    def prose(n, line=15):
        w = ["".join(chr(97 + c) for c in rng.integers(0, 26, k)) for k in rng.integers(3, 9, n)]
        return [" ".join(w[i:i + line]) for i in range(0, n, line)]

    ten = [x for x in prose(10, 1)]
    copied = prose(90, 90)[0]
    planted = {
        1000: " ".join(prose(40_000)),                                             # length
        1001: " ".join(x * 12 for x in prose(300, 1)),                             # word
        1002: "\n".join(x.replace(" ", " # ") + "#" * 60 for x in prose(300)),      # symbols
        1003: "\n".join([*prose(200), *ten, *(ten[i] for i in rng.integers(0, 10, 90))]),      # lines
        1004: " ".join([*prose(400), copied, *prose(400), copied]),                # repeats
    }
    rows = [(i, "\n".join(prose(int(rng.integers(150, 400)))), "en", "a") for i in range(300)]
    rows += [(k, t, "en", "a") for k, t in planted.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert not any(got[k]["base_failed"] for k in planted)
    assert got[1003]["n_dup_lines"] >= 90 and got[1004]["n_dup_lines"] == 0
    assert [k for k in planted if got[k]["kept"]] == []
    assert np.mean([got[i]["kept"] for i in range(300)]) > 0.98


def test_quality_rules_of_empty_table(empty):
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep(empty).count() == 0


# -------------------------------------------------------------- classifier

def test_classifier_on_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = subword_classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95


def test_classifier_of_odd_inputs(spark, documents, odd_docs, empty):
    none = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    rows = subword_classifier.classify(documents, none).collect()
    assert len(rows) == len(odd_docs) and {r["score"] for r in rows} == {0.5}
    some = spark.createDataFrame([(r[0], r[0] % 2, 0) for r in odd_docs], "doc_id long, quality int, toxic int")
    rows = subword_classifier.classify(documents, some).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert subword_classifier.classify(empty, some).count() == 0


def test_scores_do_not_depend_on_blocks(odd_docs):
    import pyarrow as pa
    texts = pa.array([r[1] for r in odd_docs], pa.string())
    amount = np.random.default_rng(0).normal(size=subword_classifier.BUCKETS).astype(np.float32)
    scores = [np.concatenate([subword_classifier.score_block(d, o, amount, 0.1) for _, _, d, o in text_blocks(texts, size)])
              for size in (1, 1000, 1 << 22)]
    assert (scores[0] == scores[1]).all() and (scores[1] == scores[2]).all()


# -------------------------------------------------------------------- WARC

def test_archive_round_trip(spark):
    rows = [(5, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (7, None, None), (9, "u\r\nv", ""), (3, "c", "é" * 1000),
            (2, "http://b/", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = warc.write(pages, warc.fresh_path(spark))
    got = sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.index(spark, path).collect())
    assert got == sorted([(2, "response", None, 8), (2, "revisit", 2, 8), (3, "response", None, 2000), (5, "revisit", 2, 8),
                          (7, "response", None, 0), (9, "revisit", 7, 0)], key=lambda r: r[:2]) or Counter(got) == Counter(
        [(2, "response", None, 8), (2, "revisit", 2, 8), (3, "response", None, 2000), (5, "revisit", 2, 8),
         (7, "response", None, 0), (9, "revisit", 7, 0)])
    payload = {(r["page_id"], bytes(r["payload"])) for r in warc.records(spark, path).collect()}
    assert payload == {(p, (h or "").encode()) for p, _, h in rows}
    for r in warc.records(spark, path).collect():
        head = bytes(r["header"])
        assert bytes(r["record"]) == head + bytes(r["payload"]) + b"\r\n\r\n"
        assert f"Content-Length: {len(r['payload'])}\r\n".encode() in head and head.startswith(b"WARC/1.1\r\n")
    assert spark.read.parquet(f"{path}/payloads").count() == 3


def test_archive_digest_and_damage(spark):
    import base64
    import hashlib
    pages = spark.createDataFrame([(1, "a", "hello")], "page_id long, url string, html string")
    path = warc.write(pages, warc.fresh_path(spark))
    assert warc.index(spark, path).first()["payload_digest"] == base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    other = f"{path}-damaged"
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"hellO")).write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="archive damaged"):
        warc.index(spark, other).collect()
    none = warc.write(pages.limit(0), warc.fresh_path(spark))
    assert warc.index(spark, none).count() == 0


def test_archive_without_revisits_of_short_payloads(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "page_id long, url string, html string")
    path = warc.write(pages, warc.fresh_path(spark), min_revisit=2)
    assert {r["record_type"] for r in warc.index(spark, path).collect()} == {"response"}


# ------------------------------------------------------------------- top k

def brute_top(vectors, queries, k):
    out = []
    for q, x in queries:
        scores = sorted(((-int(np.dot(x, y)), v) for v, y in vectors if v != q))[:k]
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(int(i), rng.integers(-40, 40, 6).tolist()) for i in range(600)]
    vectors += [(1000 + i, [7, 7, 7, 7, 7, 7]) for i in range(200)]            # a common vector: ties
    df = spark.createDataFrame(vectors, "vec_id long, x array<long>")
    asked = df.filter("vec_id % 50 = 0")
    got = kdtree.top_k(df, asked, 5, shard_rows=97, block_queries=5, leaf=8)
    assert sorted(map(tuple, got.collect())) == brute_top(vectors, [v for v in vectors if v[0] % 50 == 0], 5)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("inf"), 0.0]), (50, [-0.01, 0.5]),
            (51, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("extra", F.lit(1))
    v = kdtree.quantised(df)
    assert sorted(v.collect())[0]["x"] == [256, 512]
    got = kdtree.top_k(v, v.filter("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 50, -3 * 256 + 128 * 512), (50, 1, 0, -3 * 256 + 128 * 512)]
    assert kdtree.top_k(v.limit(0), v.limit(0)).count() == 0
