"""Session defaults and the shared scratch location.

Scratch data (landed files, stream checkpoints, written tables) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  A local folder
is created only when that setting is absent (tests, a laptop).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a small dimension is broadcast only below this many bytes
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # reliable checkpoints (lineage cuts in the shared folder) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Streaming state (dedup keys, open windows, stream-stream join buffers) lives in
# RocksDB on executor disk instead of the JVM heap, with changelog checkpoints so
# a micro-batch uploads only its changes.  A query restarted from a checkpoint keeps
# the provider it was started with (Spark stores it in the offset log).
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_SPARK_DEFAULT_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewell", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**DEFAULT_CONF, **STATE_STORE_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the settings results depend on (time zone) on an existing session, and
    use the RocksDB state store unless the session chose a provider of its own."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, _SPARK_DEFAULT_PROVIDER) == _SPARK_DEFAULT_PROVIDER:
        for k, v in STATE_STORE_CONF.items():
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for scratch data: ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a fresh local folder
    created and registered, so later calls agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewell-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        # DataFrame.checkpoint() writes under the context's folder: the same shared place
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder name under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder on its file system, making the parent of the target."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = a.getFileSystem(conf)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds on its file system; none where there is no such folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own on its file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)
