"""N-gram Jaccard self-join by vertical partitioning.

A document is the set of its distinct word n-grams.  Two documents link when
``100 * |A and B| >= threshold * |A or B|``; the result is one row per
document with the smallest id that links reach.

1. *Frequencies.*  N-gram hashes are dealt over fragments by value, packed per
   block of documents, so a shuffled row holds thousands of them.  A fragment
   counts in how many documents each n-gram occurs and answers with those
   found twice or more.  A document linked with another text needs at least
   ``threshold`` percent such n-grams; the others are done.
2. *Classes.*  Equal sets (size and two 64-bit sums) form a class; one
   representative per class goes on.
3. *Candidates.*  In the global order (frequency class, hash) each set's prefix of
   ``n - ceil(threshold * n / 100) + 1`` n-grams is indexed; linked sets share
   a prefix n-gram.  Within an n-gram's list, members are first paired with a
   few hubs only.  What then lies in one component needs no more pairs; after
   ``HUBS`` rounds all pairs of a list that are still in different components
   are tested, so no link between components is lost.
4. *Overlaps.*  The global order is cut into ``CUTS`` fragments; a pair's
   common n-grams are counted per fragment and summed.
5. *Components* by contraction: every label joins its neighbour with the
   smallest random rank until no link joins two labels.

Defined cases: a text without words, or null, has size 0 and links with
nothing; fewer words than ``n`` give their sequence as one n-gram; repeated
rows are documents of their own and link; null ids do not count as the
smallest; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, total_bytes, with_row_ids
from .words import Words, mix, text_blocks

N = 4
THRESHOLD = 85                   # percent
FRAGMENT = 1 << 18               # n-grams per fragment, about
BLOCK = 1 << 16                  # rows per block at most: 16-bit row numbers
PIECE = 1 << 19                  # bytes of a block's texts whose words are held at once
SHORT = 5                        # bytes of a hash that travel; its fragment gives the rest
CUTS = 4
HUBS = (4, 32)

PACKED = ("frag long, unit long, ids array<long>, n binary, s1 binary, s2 binary, row binary, gram binary, "
          "freq binary")
NAMES = [c.split()[0] for c in PACKED.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 6
SETS = "id long, n int, s1 long, s2 long, rare int, grams array<long>, freqs array<int>"


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names=NAMES)


def _steps(row: np.ndarray) -> bytes:
    """Rising row numbers as steps, one byte each where that is enough."""
    step = np.diff(row, prepend=0)
    return step.astype(np.uint8 if not len(step) or step.max() < 256 else np.uint16).tobytes()


def _rows(steps: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, np.uint8 if len(steps) == n else np.uint16), dtype=np.int64)


def _short(gram: np.ndarray) -> bytes:
    """The low 40 bits of n-gram hashes; the fragment holds the high ones."""
    return gram.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()


def _grams(short: bytes, frag: int) -> np.ndarray:
    part = np.frombuffer(short, np.uint8).reshape(-1, SHORT)
    full = np.zeros((len(part), 8), np.uint8)
    full[:, :SHORT] = part
    return full.view("<u8").ravel() | np.uint64(frag << (8 * SHORT))


def _pack(unit: int, ids, n, s1, s2, row: np.ndarray, gram: np.ndarray, fragments: int):
    """A block's n-grams (in order of row) by fragment, and one row with the
    block's documents."""
    frag = ((gram >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
    order = np.argsort(frag.astype(np.uint16) if fragments < 1 << 16 else frag, kind="stable")
    frag, row, gram = frag[order], row[order], gram[order]
    cut = np.flatnonzero(np.diff(frag, prepend=np.uint64(fragments)))
    out = [(int(frag[a]), unit, None, None, None, None, _steps(row[a:b]), _short(gram[a:b]), None)
           for a, b in zip(cut, np.append(cut[1:], len(gram)))]
    out.append((int(mix(np.array([unit], np.uint64))[0] % np.uint64(fragments)), unit, ids,
                n.astype(np.int32).tobytes(), s1.tobytes(), s2.tobytes(), None, None, None))
    for i in range(0, len(out), 512):
        yield _table(out[i:i + 512])


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the distinct n-grams of each row, in order of row."""
    words = Words(data, offsets, lower=True)
    h, inside = words.grams(n)
    gram, row = h[inside], words.doc[:len(h)][inside]
    count = np.diff(words.first)
    for k in range(1, n):                                # texts of fewer words: one n-gram of them all
        short = np.flatnonzero(count == k)
        if len(short):
            g, _ = words.grams(k)
            gram = np.concatenate([gram, mix(g[words.first[short]] + np.uint64(k))])
            row = np.concatenate([row, short])
    order = np.argsort(gram, kind="stable")
    same = np.flatnonzero(gram[order[1:]] == gram[order[:-1]])
    if len(same):                                        # the same n-gram twice: drop it within a row
        twice = order[np.unique(np.concatenate([same, same + 1]))]
        twice = twice[np.lexsort((row[twice], gram[twice]))]
        again = (gram[twice[1:]] == gram[twice[:-1]]) & (row[twice[1:]] == row[twice[:-1]])
        keep = np.ones(len(gram), dtype=bool)
        keep[twice[1:][again]] = False
        gram, row = gram[keep], row[keep]
    if (np.diff(row) < 0).any():                         # short texts came last
        order = np.argsort(row, kind="stable")
        gram, row = gram[order], row[order]
    return row, gram


def _signature(row: np.ndarray, gram: np.ndarray, rows: int):
    n = np.bincount(row, minlength=rows)
    s1, s2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    np.add.at(s1, row, mix(gram ^ np.uint64(0x5851F42D4C957F2D)))
    np.add.at(s2, row, mix(gram + np.uint64(0x14057B7EF767814F)))
    return n, s1.view(np.int64), s2.view(np.int64)


def _pieces(offsets: np.ndarray):
    """``(first row, end row)`` of runs with at most ``PIECE`` bytes (one row at least)."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1)
        yield a, b
        a = b


def _block(data: np.ndarray, offsets: np.ndarray, n: int):
    """``row, gram, n, s1, s2`` of a block's texts.  Words and their temporary
    arrays take some 100 bytes a word, so they are made for one piece at a time;
    10 bytes an n-gram stay."""
    parts = []
    for a, b in _pieces(offsets):
        row, gram = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)
        parts.append(((row + a).astype(np.uint16), gram, *_signature(row, gram, b - a)))
    return [np.concatenate(p) for p in zip(*parts)]


def _from_texts(documents: DataFrame, n: int, fragments: int) -> DataFrame:
    def run(batches):
        unit = TaskContext.get().partitionId() << 24
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch["text"]):
                for lo in range(a, b, BLOCK):
                    hi = min(b, lo + BLOCK)
                    off = offsets[lo - a:hi - a + 1]
                    row, gram, count, s1, s2 = _block(data[off[0]:off[-1]], off - off[0], n)
                    yield from _pack(unit, batch["id"].slice(lo, hi - lo).to_pylist(), count, s1, s2, row, gram, fragments)
                    unit += 1

    return documents.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(run, PACKED)


def _count_fragment(table: pa.Table) -> pa.Table:
    """Keeps the n-grams that two or more documents have, with that number."""
    rows = table.to_pylist()
    out = [tuple(r[c] for c in NAMES) for r in rows if r["ids"] is not None]
    parts = [r for r in rows if r["gram"] is not None]
    if parts:
        grams = [_grams(r["gram"], 0) for r in parts]
        _, inverse, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        freq = count[inverse]
        at = 0
        for r, g in zip(parts, grams):
            f = freq[at:at + len(g)]
            at += len(g)
            keep = f > 1
            if keep.any():
                # a frequency's class: quarters of its binary logarithm
                kind = np.minimum(255, np.log2(f[keep]) * 4).astype(np.uint8)
                out.append((r["frag"], r["unit"], None, None, None, None, _steps(_rows(r["row"], len(g))[keep]),
                            _short(g[keep]), kind.tobytes()))
    return pa.Table.from_batches([_table(out)]) if out else pa.table([pa.array([], k) for k in KINDS], names=NAMES)


def _regroup(table: pa.Table, threshold: int) -> pa.Table:
    """A block's documents with their shared n-grams in global order, or with
    null where too few are shared for any link."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["ids"] is not None)
    ids, n = head["ids"], np.frombuffer(head["n"], np.int32)
    parts = [r for r in rows if r["gram"] is not None]
    freqs = [np.frombuffer(r["freq"], np.uint8) for r in parts]
    freq = np.concatenate(freqs or [np.zeros(0, np.uint8)])
    row = np.concatenate([_rows(r["row"], len(f)).astype(np.uint16) for r, f in zip(parts, freqs)] or [np.zeros(0, np.uint16)])
    gram = np.concatenate([_grams(r["gram"], r["frag"]) for r in parts] or [np.zeros(0, np.uint64)])
    shared = np.bincount(row, minlength=len(ids))
    alive = (shared * 100 >= threshold * n) & (n > 0)
    keep = alive[row]
    row, gram, freq = row[keep], gram[keep], freq[keep]
    order = np.lexsort((gram, freq, row))
    row, gram, freq = row[order], gram[order].view(np.int64), freq[order].astype(np.int32)
    first = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ids)))]).astype(np.int32))
    few = pa.array(~alive)
    grams = pa.ListArray.from_arrays(first, pa.array(gram), mask=few)
    freqs = pa.ListArray.from_arrays(first, pa.array(freq), mask=few)
    return pa.table([pa.array(ids, pa.int64()), pa.array(n, pa.int32()),
                     pa.array(np.frombuffer(head["s1"], np.int64)), pa.array(np.frombuffer(head["s2"], np.int64)),
                     pa.array((n - shared).astype(np.int32)), grams, freqs],
                    names=[c.split()[0] for c in SETS.split(", ")])


def shared_grams(packed: DataFrame, threshold: int) -> DataFrame:
    counted = packed.groupBy("frag").applyInArrow(_count_fragment, PACKED)
    return counted.groupBy("unit").applyInArrow(lambda t: _regroup(t, threshold), SETS)


def _need(n: Column, threshold: int) -> Column:
    return F.ceil(n * threshold / F.lit(100.0))


def _cut(sets: DataFrame) -> DataFrame:
    """``(id, cut, grams)``: each set's n-grams by fragment of the global
    order.  The cut points are medians of what stands at even steps of the
    sets; they only balance the fragments."""
    steps = [F.percentile_approx(F.get("freqs", F.floor(F.size("freqs") * i / CUTS).cast("int")), F.lit(0.5))
             for i in range(1, CUTS)]
    at = [x or 0 for x in sets.agg(*steps).first()]
    bounds = [0, *np.maximum.accumulate(at).tolist(), (1 << 31) - 1]

    def within(i):
        return lambda g, k: (F.get("freqs", k) >= bounds[i]) & (F.get("freqs", k) < bounds[i + 1])

    parts = [F.struct(F.lit(i).alias("cut"), F.filter("grams", within(i)).alias("grams")) for i in range(CUTS)]
    rows = sets.select("id", F.explode(F.array(*parts)).alias("p")).select("id", "p.cut", "p.grams")
    return rows.filter(F.size("grams") > 0)


def linked(pairs: DataFrame, cuts: DataFrame, threshold: int, few: bool) -> DataFrame:
    """The pairs ``(a, b, na, nb)`` that link: common n-grams are counted per
    fragment of the order and summed per pair."""
    left = F.broadcast(pairs) if few else pairs
    x = cuts.withColumnRenamed("grams", "ga").join(left, cuts["id"] == pairs["a"]).drop("id")
    y = cuts.select(F.col("id").alias("b"), "cut", F.col("grams").alias("gb"))
    part = x.join(y, ["b", "cut"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("common"))
    both = part.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return both.filter(F.col("common") * (100 + threshold) >= threshold * (F.col("na") + F.col("nb"))).select("a", "b")


def _relabel(rows: DataFrame, column: str, to: DataFrame, few: bool) -> DataFrame:
    """``rows`` with ``column`` sent through ``to`` (``id``, ``label``); what
    is not in there stays."""
    small = to.select(F.col("id").alias("__id"), F.col("label").alias("__label"))
    small = F.broadcast(small) if few else small
    return rows.join(small, rows[column] == small["__id"], "left") \
        .withColumn(column, F.coalesce("__label", column)).drop("__id", "__label")


def contract(moved: DataFrame, links: DataFrame, salt: int, few: bool) -> DataFrame:
    """``moved`` (``id``, ``label`` of the sets that do not keep their own id
    as label) after joining the components of the pairs ``(a, b)``."""
    edge = _relabel(_relabel(links, "a", moved, few), "b", moved, few).select(F.col("a").alias("u"), F.col("b").alias("v"))
    total, turn = None, 0
    while True:
        edge = materialize(edge.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                           .distinct(), "join-edges")
        n = edge.count()
        if not n:
            break
        small = 2 * n <= BROADCAST_ROWS                      # an edge has two ends
        rank = lambda c: F.xxhash64(F.lit(salt * 1000 + turn), F.col(c))
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = both.groupBy("u").agg(F.min(F.struct(rank("v").alias("r"), F.col("v"))).alias("best")).select(
            F.col("u").alias("id"), F.when(F.col("best.r") < rank("u"), F.col("best.v")).otherwise(F.col("u")).alias("label"))
        to = materialize(to, "join-map")
        to = _relabel(to, "label", to, small)                # one jump more
        total = to if total is None else _relabel(total, "label", to, small).unionByName(to.join(total, "id", "left_anti"))
        total = materialize(total, "join-total")
        edge = _relabel(_relabel(edge, "u", to, small), "v", to, small)
        turn += 1
    if total is None:
        return moved
    few = few and total.count() <= BROADCAST_ROWS
    new = _relabel(moved, "label", total, few).unionByName(total.filter("id <> label"))
    return materialize(new, "join-moved")


def components(sets: DataFrame, threshold: int, hubs=HUBS) -> DataFrame:
    """``(id, label)`` of sets (a written table of ``SETS`` rows with n-grams):
    equal labels for sets that links connect."""
    ids = sets.select("id", F.col("id").alias("label"))
    take = F.col("n") - _need(F.col("n"), threshold) + 1 - F.col("rare")
    # room: the most n-grams that can be common if this one is the first
    lists = sets.select("id", "n", "rare", F.posexplode(F.slice("grams", 1, F.greatest(take, F.lit(0)).cast("int")))
                        .alias("p", "gram")).select("id", "n", (F.col("n") - F.col("rare") - F.col("p")).alias("room"), "gram")
    often = lists.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1").select("gram")
    lists = materialize(lists.join(often, "gram"), "join-lists")
    if lists.isEmpty():
        return ids
    cuts = materialize(_cut(sets.join(lists.select("id").distinct(), "id", "left_semi")), "join-cuts")
    moved = materialize(ids.limit(0), "join-moved")
    tested, n_moved = None, 0
    for turn, k in enumerate([*hubs, None]):
        few = n_moved <= BROADCAST_ROWS
        named = _relabel(lists.withColumn("label", F.col("id")), "label", moved, few)
        if n_moved:
            open_ = named.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")) \
                         .filter("lo <> hi").select("gram")
            named = named.join(open_, "gram")
        if k is None:
            hub = named
        else:                                       # members of the largest components first
            sizes = moved.groupBy("label").count().select(F.col("label").alias("__s"), "count")
            sizes = F.broadcast(sizes) if few else sizes
            order = Window.partitionBy("gram").orderBy(F.col("count").desc_nulls_last(), F.xxhash64(F.lit(turn), "id"))
            hub = named.join(sizes, named["label"] == sizes["__s"], "left") \
                       .withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k)
        hub = hub.select("gram", F.col("id").alias("hid"), F.col("n").alias("hn"), F.col("room").alias("hroom"),
                         F.col("label").alias("hlabel"))
        # the first common n-gram of a linked pair leaves room for all the others
        near = (F.col("label") != F.col("hlabel")) & (
            F.least("room", "hroom") * (100 + threshold) >= threshold * (F.col("n") + F.col("hn")))
        if k is None:
            near = near & (F.col("id") < F.col("hid"))
        first = F.col("id") < F.col("hid")
        pairs = named.join(hub, "gram").filter(near).select(
            F.least("id", "hid").alias("a"), F.greatest("id", "hid").alias("b"),
            F.when(first, F.col("n")).otherwise(F.col("hn")).alias("na"),
            F.when(first, F.col("hn")).otherwise(F.col("n")).alias("nb")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "join-pairs")
        count = pairs.count()
        if not count:
            continue
        seen = pairs.select("a", "b")
        tested = seen if tested is None else tested.unionByName(seen)
        links = materialize(linked(pairs, cuts, threshold, count <= BROADCAST_ROWS), "join-links")
        moved = contract(moved, links, turn, few and count <= BROADCAST_ROWS)
        n_moved = moved.count()
    return _relabel(ids, "label", moved, n_moved <= BROADCAST_ROWS)


def join(documents: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document."""
    fragments = max(1, -(-total_bytes(documents, "text") // (6 * FRAGMENT)))
    docs = materialize(shared_grams(_from_texts(documents, n, fragments), threshold), "join-docs")
    alive = docs.filter("grams is not null")
    # one representative per class of equal sets; size and sums name a class
    reps = alive.groupBy("n", "s1", "s2").agg(F.min_by(F.struct("rare", "grams", "freqs"), "rare").alias("set"))
    reps = materialize(reps.select("n", "s1", "s2", "set.rare", "set.grams", "set.freqs")
                       .withColumn("id", F.monotonically_increasing_id()), "join-classes")
    labels = materialize(components(reps, threshold), "join-components")
    classes = reps.select(F.col("id").alias("class"), "n", "s1", "s2") \
        .join(labels.select(F.col("id").alias("class"), "label"), "class", "left") \
        .select("n", "s1", "s2", F.coalesce("label", "class").alias("label"))
    named = alive.select("id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]).select("id", "n", "label")
    least = named.groupBy("label").agg(F.min("id").alias("least"))
    member = named.join(least, "label").select("id", "n", "least")
    rest = docs.filter("grams is null").select("id", "n", F.col("id").alias("least"))
    return member.unionByName(rest).select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                                           F.col("least").alias("component_id"))


def distinct(documents: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """The first document (smallest doc_id) of every group, same columns."""
    rows = with_row_ids(documents)
    first = join(rows.select(F.col("__rid").alias("doc_id"), "text"), n, threshold) \
        .filter("doc_id = component_id").select(F.col("doc_id").alias("__rid"))
    return rows.join(first, "__rid", "left_semi").select(*documents.columns)
