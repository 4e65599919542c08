"""Sinks: message topic, keyed hash (current-state table), document index,
JDBC append and fan-out to several outputs.  Each works on a batch DataFrame
and, through ``foreach_batch``, on every micro-batch of a stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete, folders, path_exists, rename_over, replace_text


def topic_payload(df: DataFrame, value: str | Column | None = None) -> DataFrame:
    """The message value of each record: a string column as is, otherwise
    the whole record as JSON.  No key."""
    if value is None:
        v = (F.col(df.columns[0]) if len(df.columns) == 1 and
             dict(df.dtypes)[df.columns[0]] == "string" else F.to_json(F.struct(*df.columns)))
    else:
        v = F.col(value) if isinstance(value, str) else value
    return df.select(v.cast("string").alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, value: str | Column | None = None) -> None:
    """Append every record as one message (needs the Kafka connector jar)."""
    (topic_payload(df, value).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


MANIFEST = "manifest.txt"


def _base(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """The merged folder that the manifest names and the newest version in it."""
    if not path_exists(spark, f"{path}/{MANIFEST}"):
        return None, -1
    name, upto = spark.read.text(f"{path}/{MANIFEST}").first()[0].split(" ")
    return name, int(upto)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions whose write has finished."""
    if not path_exists(spark, path):
        return []
    found = [(d, int(d.rpartition("=")[2])) for d in folders(spark, path) if "/_version=" in d]
    return sorted(v for d, v in found if path_exists(spark, f"{d}/_SUCCESS"))


def _live(spark: SparkSession, path: str) -> DataFrame | None:
    """``field, value, _version`` of the live folders: the merged one and all
    finished versions after it."""
    name, upto = _base(spark, path)
    after = [f"{path}/_version={v}" for v in _versions(spark, path) if v > upto]
    log = spark.read.option("basePath", path).parquet(*after) if after else None
    if name is None:
        if log is None and path_exists(spark, path) and not any("/_version=" in d for d in folders(spark, path)):
            raise ValueError(f"{path} is not a hash table")
        return log
    merged = spark.read.parquet(f"{path}/{name}")
    return merged if log is None else log.unionByName(merged.select(log.columns))


def read_hash(spark: SparkSession, path: str) -> DataFrame | None:
    """Current content of a hash table written by ``upsert_hash``: the value
    of the newest write of each field (a grouped ``max`` of a struct, so it
    combines map-side).  ``None`` if nothing was written yet; a table that is
    there but cannot be read is an error."""
    log = _live(spark, path)
    if log is None:
        return None
    field, value = [c for c in log.columns if c != "_version"][:2]
    # one row per field per write: the newest write wins
    return log.groupBy(field).agg(F.max(F.struct("_version", F.col(value).alias("_v")))["_v"]
                                  .alias(value))


def upsert_hash(df: DataFrame, path: str, field: str, value: str, order: Sequence[str],
                version: int | None = None) -> DataFrame:
    """Hash upsert ``HSET name field value``: the latest value per field of
    this input replaces the stored one; other fields are kept.

    The table is a log: each upsert writes only its own latest row per field,
    in the folder of its ``version`` (cost grows with the batch, not the
    table).  Give a stream's batch id as version: a retried batch replaces
    its own write, and one that is already merged changes nothing.  Without one
    the next free number is taken.  A folder counts once its write has finished.
    ``read_hash`` resolves the newest value per field, ``compact_hash`` merges
    the log.  Returns the current content.
    """
    spark = df.sparkSession
    if version is None:
        version = max([*_versions(spark, path), _base(spark, path)[1]]) + 1
    st = F.struct(*[F.col(o) for o in order])
    upd = (df.groupBy(field).agg(F.max(F.struct(st.alias("_o"), F.col(value).alias("_v"))).alias("_m"))
           .select(field, F.col("_m._v").alias(value)))
    upd.write.mode("overwrite").parquet(f"{path}/_version={version}")
    return read_hash(spark, path)


def compact_hash(spark: SparkSession, path: str) -> None:
    """Merges the finished versions into one folder.

    The merged rows go to a new folder, which counts only once the manifest
    names it; the manifest is replaced in a single rename.  What it no longer
    names is deleted after that.  A stop between any two of these steps leaves
    the same content, and the next run clears what was left over.  The rename
    must be atomic, as on HDFS and local disks.  Batches may write meanwhile;
    two compactions may not run at once.
    """
    for step in compaction_steps(spark, path):
        step()


def compaction_steps(spark: SparkSession, path: str) -> list[Callable[[], None]]:
    """The steps of ``compact_hash``, in order."""
    versions = _versions(spark, path)
    name, upto = _base(spark, path)
    merged = f"merged-{uuid.uuid4().hex[:12]}"
    aside = f"{path}/manifest.next"

    def merge() -> None:
        log = _live(spark, path)
        field, value = [c for c in log.columns if c != "_version"][:2]
        log = log.where(F.col("_version") <= newest).groupBy(field).agg(
            F.max(F.struct("_version", F.col(value).alias("_v"))).alias("_m"))
        log.select(field, F.col("_m._v").alias(value), F.col("_m._version").alias("_version")).write.parquet(f"{path}/{merged}")

    def note() -> None:
        replace_text(spark, aside, f"{merged} {newest}")

    def swap() -> None:
        rename_over(spark, aside, f"{path}/{MANIFEST}")

    def clear() -> None:
        live, done = _base(spark, path)
        for folder in folders(spark, path):
            last = folder.rpartition("/")[2]
            old = last.startswith("_version=") and int(last.rpartition("=")[2]) <= done
            if old or (last.startswith("merged-") and last != live):
                delete(spark, folder)

    newest = max(versions, default=-1)
    if len([v for v in versions if v > upto]) + (name is not None) < 2:
        return [clear] if name is not None else []
    return [merge, note, swap, clear]


def index_docs(df: DataFrame, path: str, col: str, batch_id: int | None = None) -> None:
    """One JSON document ``{"data": <record>}`` per record, appended.  With a
    ``batch_id`` the documents are those of that batch: written again, they
    replace themselves."""
    docs = df.select(F.col(col).cast("string").alias("data"))
    if batch_id is None:
        docs.write.mode("append").json(path)
    else:
        docs.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                batch_size: int = 1000) -> None:
    """``INSERT INTO table VALUES (...)`` for every record, in batches of
    ``batch_size`` statements per executor connection."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table, mode="append", properties=props)


def fan_out(df: DataFrame, outputs: Mapping[str, Column], fmt: str = "parquet", batch_id: int | None = None) -> None:
    """One job, several outputs: ``{path: predicate}``; the input is cached
    once (memory and disk) and each output is a filtered append.  With a
    ``batch_id`` each output gets that batch's rows in a folder of their own,
    which a retried batch replaces."""
    cached = df.persist()
    try:
        for path, pred in outputs.items():
            part = cached.where(pred).write.format(fmt)
            if batch_id is None:
                part.mode("append").save(path)
            else:
                part.mode("overwrite").save(f"{path}/batch_id={batch_id}")
    finally:
        cached.unpersist()


def foreach_batch(writer: Callable[[DataFrame], None], done_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """Adapt a batch writer to ``writeStream.foreachBatch``.

    A micro-batch may come again after a failure.  With ``done_path`` the id
    of each finished batch is noted there and such a batch is left out when it
    comes again.  A failure between the write and the note still repeats it:
    for exact results use a writer that replaces by batch id
    (``write_batch``, ``upsert_hash`` with ``version``)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if done_path and path_exists(spark, f"{done_path}/{batch_id}"):
            return
        writer(batch)
        if done_path:
            spark.range(1).write.mode("overwrite").parquet(f"{done_path}/{batch_id}")
    return run


def write_batch(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer with one folder per batch id: a retried batch
    replaces its own rows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return run
