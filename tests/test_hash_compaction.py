"""A hash table reads the same whenever its compaction stops."""

import pytest

from tidepool.session import folders, path_exists
from tidepool.sinks import writers


def _df(spark, *rows):
    return spark.createDataFrame(rows, "f string, v long, o long")


def _read(spark, path):
    return {r["f"]: r["v"] for r in writers.read_hash(spark, path).collect()}


def _table(spark, path):
    writers.upsert_hash(_df(spark, ("a", 1, 1), ("b", 1, 1)), path, "f", "v", ["o"], version=0)
    writers.upsert_hash(_df(spark, ("a", 5, 1), ("a", 2, 2), ("c", 7, 1)), path, "f", "v", ["o"], version=1)
    return {"a": 2, "b": 1, "c": 7}


@pytest.mark.parametrize("stop", range(5))
def test_stop_between_any_two_steps(spark, tmp_path, stop):
    path = str(tmp_path / "h")
    want = _table(spark, path)
    for step in writers.compaction_steps(spark, path)[:stop]:
        step()
    assert _read(spark, path) == want
    # a batch written after the stop, an old one that comes again, then a full run
    writers.upsert_hash(_df(spark, ("b", 9, 1)), path, "f", "v", ["o"], version=2)
    writers.upsert_hash(_df(spark, ("a", 5, 1), ("a", 2, 2), ("c", 7, 1)), path, "f", "v", ["o"], version=1)
    want["b"] = 9
    assert _read(spark, path) == want
    writers.compact_hash(spark, path)
    assert _read(spark, path) == want
    writers.compact_hash(spark, path)
    assert _read(spark, path) == want
    left = [f.rpartition("/")[2] for f in folders(spark, path)]
    assert len(left) == 1 and left[0].startswith("merged-") and not path_exists(spark, f"{path}/manifest.next")


def test_a_batch_during_the_compaction_is_kept(spark, tmp_path):
    path = str(tmp_path / "h")
    want = _table(spark, path)
    for i, step in enumerate(writers.compaction_steps(spark, path)):
        step()
        writers.upsert_hash(_df(spark, (f"new{i}", i, 1)), path, "f", "v", ["o"])
        want[f"new{i}"] = i
        assert _read(spark, path) == want


def test_an_unfinished_write_does_not_count(spark, tmp_path):
    path = str(tmp_path / "h")
    want = _table(spark, path)
    writers.upsert_hash(_df(spark, ("a", 100, 1)), path, "f", "v", ["o"], version=2)
    (tmp_path / "h" / "_version=2" / "_SUCCESS").unlink()
    assert _read(spark, path) == want
    writers.compact_hash(spark, path)
    assert _read(spark, path) == want
    writers.upsert_hash(_df(spark, ("a", 100, 1)), path, "f", "v", ["o"], version=2)
    assert _read(spark, path) == {**want, "a": 100}


def test_nothing_to_compact(spark, tmp_path):
    path = str(tmp_path / "h")
    writers.compact_hash(spark, path)
    assert writers.read_hash(spark, path) is None
    writers.upsert_hash(_df(spark, ("a", 1, 1)), path, "f", "v", ["o"])
    writers.compact_hash(spark, path)
    assert _read(spark, path) == {"a": 1}


def test_batch_ids_replace_themselves(spark, tmp_path):
    docs, hi, lo = (str(tmp_path / n) for n in ("docs", "hi", "lo"))
    df = _df(spark, ("a", 1, 1), ("b", 9, 1))
    for _ in range(2):
        writers.index_docs(df, docs, "f", batch_id=3)
        writers.fan_out(df, {hi: df["v"] > 5, lo: df["v"] <= 5}, batch_id=3)
    assert sorted(r["data"] for r in spark.read.json(docs).collect()) == ["a", "b"]
    assert spark.read.parquet(hi).count() == 1 and spark.read.parquet(lo).count() == 1
