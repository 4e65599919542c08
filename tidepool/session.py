"""Session helpers: one place that decides how a session is configured.

On a cluster the session is created by the platform; the library only reads
its settings.  ``local_session`` is for tests, the bench and the smoke entry.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library relies on.  Applied by ``local_session``
# and checked (not forced) on an existing session.
REQUIRED_CONF = {
    # event time is epoch based; printing and parsing use UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: partition coalescing, skew-join splitting and
    # broadcast conversion from *measured* sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tidepool") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    parts = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system path and is never
    overridden; a session without it fails here, before executors write where
    the others cannot read.  Only a single-JVM session (tests) gets a fresh
    scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def chunk_rows(spark: SparkSession) -> int:
    """Rows of one key that an ordered scan reads in one piece: the setting
    ``spark.tidepool.chunkRows``, one million by default."""
    return int(spark.conf.get("spark.tidepool.chunkRows", "1000000"))


def materialize(df, name: str = "table"):
    """Write ``df`` as a parquet table under the shared checkpoint folder
    (``spark.checkpoint.dir``) and return a DataFrame reading it back:
    lineage is cut, lost executors do not lose it, and the read has exact
    size statistics.

    Used where several later jobs (boundary sampling, the final action)
    would otherwise recompute an expensive intermediate result.
    """
    import uuid
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Marks an intermediate folder for deletion when the session ends."""
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote (on any Hadoop file system)."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text file (over an earlier one)."""
    fs, p = _file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def rename_over(spark: SparkSession, source: str, target: str) -> None:
    """Puts a file in the place of another in one step of the file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.getFileSystem(conf).getUri(), conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    files.rename(src, dst, options)


def set_times(spark: SparkSession, files: list[str], first_ms: int) -> None:
    """Gives files rising modification times, one second apart."""
    for i, f in enumerate(files):
        fs, p = _file_system(spark, f)
        fs.setTimes(p, first_ms + 1000 * i, -1)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under ``path``."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The part files of a written folder, by name."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))


def ship_package(spark: SparkSession) -> None:
    """Make ``tidepool`` importable in the Python workers (``addPyFile`` of a
    zip of the package, once per SparkContext).  Needed whenever a pandas
    function refers to library code and the workers do not have it
    installed.  The zip is written under the shared checkpoint folder."""
    import uuid
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_tidepool_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    dest = os.path.join(ensure_checkpoint_dir(spark), "pyfiles")
    local = dest[len("file:"):] if dest.startswith("file:") else dest
    if "://" in local:
        # a remote shared folder: build the zip next to the package instead
        local = tempfile.mkdtemp(prefix="tidepool-pyfiles-")
    os.makedirs(local, exist_ok=True)
    path = os.path.join(local, f"tidepool-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._tidepool_shipped = True
