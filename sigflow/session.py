"""Session construction and cluster-facing settings."""

from __future__ import annotations

import hashlib
import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every sigflow job relies on. ANSI mode stays on (the Spark 4
# default); parsers use try_* functions instead of turning it off.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split oversized shuffle partitions (hot keys) and merge tiny ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (windows, de-duplication) in RocksDB: off the JVM heap,
    # spilling to local disk, checkpointed incrementally to the shared folder.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Remove DataFrame.checkpoint() files from the shared folder once the
    # checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Table-format and message-bus connectors are optional: they need their jars
# (``spark.jars.packages`` or the cluster's classpath).
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    master: str | None = None,
    app_name: str = "sigflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    delta: bool = False,
    packages: list[str] | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """Create (or reuse) a session with sigflow's defaults.

    ``master`` is only set when given, so ``spark-submit`` on a cluster keeps
    its own master. ``shuffle_partitions`` is the *initial* width; AQE
    coalesces it at run time, so on a cluster set it generously
    (e.g. 2-3x total cores) and let AQE shrink it. ``checkpoint_dir`` is used
    only where the cluster names none.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if delta:
        conf.update(DELTA_CONF)
    if packages:
        conf["spark.jars.packages"] = ",".join(packages)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # no SparkContext handle (e.g. a Connect session)
        pass
    if checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", checkpoint_dir)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Streaming checkpoints, run folders and lineage cuts go below it. There is
    no fallback: a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Connect sessions only know the setting
            root = None
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
    return root


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of one's own from whatever store it lies in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` write under the shared root."""
    root = checkpoint_root(spark)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # Connect sessions take the directory from the conf
        pass
    return root


def stream_checkpoint(spark: SparkSession, name: str, *ends: str | None) -> str:
    """Checkpoint location for a named streaming query under the shared root.

    ``ends`` are what the query reads and writes: the same stage between other
    ends is another query and has its own checkpoint.
    """
    key = hashlib.sha1("\n".join(str(e) for e in ends).encode()).hexdigest()[:12]
    return os.path.join(checkpoint_root(spark), "streams", f"{name}-{key}" if ends else name)


@contextmanager
def conf_override(spark: SparkSession, settings: dict[str, str]):
    """Set session settings for the duration of a block, then restore them."""
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def state_partitions(spark: SparkSession) -> dict[str, str]:
    """Shuffle width for a new stateful stream: one state partition per core of
    the cluster. A stream keeps the width it started with (it is stored in
    its checkpoint), so this only matters when a query first starts."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:
        return {}
    return {"spark.sql.shuffle.partitions": str(cores)}
