"""Replay a bounded table as a stream, run a streaming query, read the result.

``stage`` writes the table once, range-partitioned by arrival order into
``n_files`` parquet files with rising modification times (the file source
takes files in that order) plus, optionally, sentinel files holding one
far-future record that moves the watermark past every real window: a bounded
input's final flush (its own window never closes, so it never reaches an
append-mode result).  ``run`` reads the folder with ``maxFilesPerTrigger=1``
(one micro-batch per file of a small table), applies the streaming transform, runs it with
``availableNow`` and returns the sink's content as a batch DataFrame.

A micro-batch of a larger table is several files (``maxFilesPerTrigger``), so
that all cores read it; there are at most ``BATCHES`` micro-batches, so what
each of them costs besides its records (tasks, commits of state) does not grow
with the table.

Folders live under the session's ``spark.checkpoint.dir``, one fresh
sub-folder per run; the staged input and the stream's checkpoint are deleted
after the run, the sink at the end of the session.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import (chunk_rows, data_files, delete, delete_on_exit, ensure_checkpoint_dir, folders, set_times)

SENTINEL = "_sentinel"
REPLAY = "_replay"
START_MS = 1_000_000_000_000       # modification time of the first file
BATCHES = 16                       # most micro-batches of a replay
FILE_BYTES = 64 << 20              # most bytes of records in a staged file, about


def _run_dir(spark: SparkSession, tag: str) -> str:
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "streams", f"{tag}-{uuid.uuid4().hex[:12]}")
    return path


def _files(df: DataFrame) -> int:
    """One file, so one micro-batch, per chunk of rows; four at least."""
    return max(4, -(-df.count() // chunk_rows(df.sparkSession)))


def _split(df: DataFrame) -> tuple[int, int]:
    """Micro-batches of a replay, and files of each: a chunk of rows makes a
    micro-batch, up to ``BATCHES`` of them; files hold a quarter of a chunk and
    ``FILE_BYTES`` at most."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
            if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(8 * len(df.columns)).cast("long")
    for c in text:
        width = width + c
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    chunk = chunk_rows(df.sparkSession)
    batches = max(4, min(BATCHES, -(-rows // chunk)))
    files = max(-(-rows // max(1, chunk // 4)), -(-size // FILE_BYTES))
    return batches, max(1, -(-files // batches))


def stage(df: DataFrame, order: Sequence[str], n_files: int, path: str,
          sentinel: dict | None = None, per_batch: int = 1) -> None:
    """Write ``df`` as ``n_files`` files in ``order`` (plus sentinel files for
    two micro-batches of ``per_batch`` files)."""
    spark = df.sparkSession
    b = df.withColumn(SENTINEL, F.lit(False))
    b.repartitionByRange(n_files, *order).sortWithinPartitions(*order).write.parquet(path)
    done = data_files(spark, path)
    set_times(spark, done, START_MS)
    if sentinel is not None:
        # files of two micro-batches: the first moves the watermark, the second
        # runs one more micro-batch in which the closed windows are emitted
        row = {c: None for c in df.columns}
        row.update(sentinel)
        n = 2 * per_batch
        copies = spark.sparkContext.parallelize([tuple(row[c] for c in df.columns)] * n, n)
        s = spark.createDataFrame(copies, df.schema)
        s.withColumn(SENTINEL, F.lit(True)).write.mode("append").parquet(path)
        before = set(done)
        set_times(spark, [f for f in data_files(spark, path) if f not in before], START_MS + 1000 * len(done))


def stage_batches(df: DataFrame, batch: str, order: Sequence[str], path: str) -> None:
    """Write ``df`` as one file per value of its whole-number column ``batch``,
    to be taken in that order: the table itself says which records a
    micro-batch holds."""
    spark = df.sparkSession
    rows = df.withColumn(SENTINEL, F.lit(False)).withColumn(REPLAY, F.col(batch))
    rows.repartition(REPLAY).sortWithinPartitions(REPLAY, *order).write.partitionBy(REPLAY).parquet(path)
    found = sorted(folders(spark, path), key=lambda f: int(f.rpartition("=")[2]))
    set_times(spark, [f for folder in found for f in data_files(spark, folder)], START_MS)


def read(spark: SparkSession, path: str, schema, per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path))


def run(df: DataFrame, order: Sequence[str], transform: Callable[[DataFrame], DataFrame],
        n_files: int | None = None, sentinel: dict | None = None, mode: str = "append",
        keys: Sequence[str] | None = None, tag: str = "q",
        each_batch: Callable[[DataFrame], DataFrame] | None = None, batch: str | None = None,
        writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None) -> DataFrame:
    """Stream ``df`` through ``transform`` and return what the sink holds.
    ``each_batch`` is applied to every micro-batch's result before it is
    written (append mode).  ``batch`` names a column that deals the records to
    micro-batches (``stage_batches``); ``writer`` makes the ``foreachBatch``
    function for a folder, in which it writes one ``batch_id=`` folder each.

    ``mode='append'`` uses the parquet file sink.  ``mode='update'`` writes
    every micro-batch's changed rows with its batch id through
    ``foreachBatch``; the result is the latest row per ``keys`` (the
    "current state" table), or with ``mode='log'`` all of them with their
    ``_batch``.
    """
    spark = df.sparkSession
    root = _run_dir(spark, tag)
    src, out, ckpt = (os.path.join(root, x) for x in ("source", "sink", "checkpoint"))
    per = 1
    if batch is None:
        if n_files is None:
            batches, per = _split(df)
            n_files = batches * per
        stage(df, order, n_files, src, sentinel, per)
    else:
        stage_batches(df, batch, order, src)
    schema = spark.read.parquet(src).schema
    stream = transform(read(spark, src, schema, per).drop(REPLAY))
    if writer is not None:
        q = (stream.writeStream.outputMode(mode).foreachBatch(writer(out))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        _clean(spark, out, src, ckpt)
        return spark.read.option("basePath", out).parquet(f"{out}/batch_id=*").drop("batch_id")
    if mode == "append" and each_batch is not None:
        def put(batch: DataFrame, batch_id: int) -> None:
            each_batch(batch).write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

        q = (stream.writeStream.outputMode("append").foreachBatch(put)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        _clean(spark, out, src, ckpt)
        return spark.read.option("basePath", out).parquet(f"{out}/_batch=*").drop("_batch")
    if mode == "append":
        q = (stream.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        q.awaitTermination()
        _clean(spark, out, src, ckpt)
        return spark.read.schema(stream.schema).parquet(out)
    if mode in ("update", "log"):
        if mode == "update" and not keys:
            raise ValueError("update mode needs the result keys")

        def write(batch: DataFrame, batch_id: int) -> None:
            # one folder per micro-batch: a retried batch replaces its own rows
            batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

        q = (stream.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        _clean(spark, out, src, ckpt)
        res = spark.read.option("basePath", out).parquet(f"{out}/_batch=*")
        if mode == "log":
            return res
        latest = res.groupBy(*keys).agg(F.max("_batch").alias("_last"))
        latest = latest.select(*[F.col(k).alias(f"_lk{i}") for i, k in enumerate(keys)], "_last")
        cond = [res[k].eqNullSafe(latest[f"_lk{i}"]) for i, k in enumerate(keys)]
        j = res.join(latest, cond + [res["_batch"] == latest["_last"]])
        return j.select(*stream.columns)
    raise ValueError(f"unsupported mode {mode!r}")


@contextmanager
def _partitions(spark: SparkSession, per_batch: int):
    """Streams started in here have a partition of state per file of a
    micro-batch, two per core at least, and no more than the session's shuffles:
    each is committed in every micro-batch, whatever its size."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), max(per_batch, 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_join(left: DataFrame, left_order: Sequence[str], right: DataFrame,
             right_order: Sequence[str], transform: Callable[[DataFrame, DataFrame], DataFrame],
             n_files: int | None = None, tag: str = "join") -> DataFrame:
    """Replay two tables as two streams (micro-batch i reads the i-th files of each,
    so both advance through time together), run a two-input streaming
    transform in append mode and return the sink's content."""
    spark = left.sparkSession
    root = _run_dir(spark, tag)
    lsrc, rsrc, out, ckpt = (os.path.join(root, x) for x in ("left", "right", "sink", "checkpoint"))
    lper = rper = 1
    if n_files is None:
        (lbatches, lper), (rbatches, rper) = _split(left), _split(right)
        n_files = max(lbatches, rbatches)
        lper, rper = -(-lbatches * lper // n_files), -(-rbatches * rper // n_files)
    stage(left, left_order, n_files * lper, lsrc, per_batch=lper)
    stage(right, right_order, n_files * rper, rsrc, per_batch=rper)
    ls = drop_sentinel(read(spark, lsrc, spark.read.parquet(lsrc).schema, lper))
    rs = drop_sentinel(read(spark, rsrc, spark.read.parquet(rsrc).schema, rper))
    stream = transform(ls, rs)
    with _partitions(spark, lper + rper):
        q = (stream.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    q.awaitTermination()
    _clean(spark, out, lsrc, rsrc, ckpt)
    return spark.read.schema(stream.schema).parquet(out)


def _clean(spark: SparkSession, out: str, *used: str) -> None:
    for path in used:
        delete(spark, path)
    delete_on_exit(spark, out)


def drop_sentinel(stream: DataFrame) -> DataFrame:
    """Drop the marker column.  The sentinel record itself is *not* filtered:
    Catalyst pushes filters below ``withWatermark`` into the scan, so a
    filtered sentinel would never move the watermark.  Choose it so it lands
    in a window / session that never closes (far future) and cannot reach an
    append-mode result."""
    return stream.drop(SENTINEL)
