"""Session construction and shared-folder resolution."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC event time, adaptive execution (runtime
# coalescing, skew-join splitting, runtime broadcast of sides measured small).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a small changelog per batch instead of snapshotting every store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    shared_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local[...]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``. Only a local master may leave it unset (tests):
    then it is a private folder of this process. On a cluster a machine-local folder
    would be a different one on every machine, so that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc.getCheckpointDir() is None and not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d or tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return d or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder written by ``materialize`` (any Hadoop file system)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the data files of a file or folder, in
    path order (any Hadoop file system; hidden files are left out)."""
    fs, p = _fs(spark, path)
    found, each = [], fs.listFiles(p, True)
    while each.hasNext():
        st = each.next()
        if not st.getPath().getName().startswith(("_", ".")):
            found.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(found)


def path_signature(spark: SparkSession, path: str) -> str:
    """Digest of the list of data files of an input, to key derived copies of it."""
    return hashlib.sha256(repr(data_files(spark, path)).encode()).hexdigest()


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, millis, -1)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file in one step (written aside, then renamed); an existing one is left."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p.getParent().toString()}/.{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not fs.rename(aside, p) and not fs.exists(p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def materialize(df, name: str, path: str | None = None):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes from these files, not from
    the source), lets a result used by several later branches be computed
    once, and gives the planner real sizes for its join choices."""
    spark = df.sparkSession
    p = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)
