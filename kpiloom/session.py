"""Session settings and the shared working folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

#: Settings every job wants, whatever the cluster. AQE picks the shuffle width and splits
#: hot keys at run time; windows and streams get their width from the session.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Sessions of one hot user are merged on the map side before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Most memory that the state stores of one executor take together, in MB.
STATE_MEMORY_MB = 512

#: Stream state lies in RocksDB: on disk beyond that memory, and a batch uploads only what it changed.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MEMORY_MB),
    # A run over all that has arrived reports every batch, not the last hundred only.
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
}

#: How often a stream that keeps running takes what has arrived and commits its state.
CHECKPOINT_INTERVAL = "60 seconds"

#: Settings that only a new session takes.
START_SETTINGS = {
    # Call sites of column expressions are not recorded: that takes much of the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "kpiloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the job settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **STREAM_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def sized_for(input_bytes: int, shuffled_share: float = 0.2) -> dict[str, str]:
    """Settings for ``build_session`` that keep tasks near 256 MB for a given input size.

    ``shuffled_share`` is the part of the input that passes through the widest shuffle; order
    lines against order heads move about a fifth of the raw bytes. AQE merges what turns out
    small, so the number is an upper bound.
    """
    task = 256 * 1024**2
    partitions = max(math.ceil(input_bytes * shuffled_share / task), 200)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
        "spark.sql.files.maxPartitionBytes": "256MB",
    }


def tune(spark: SparkSession) -> SparkSession:
    """Apply the job settings to a session made elsewhere.

    The job settings are set whatever the session had before: results are compared in UTC, and loads rely on
    dynamic partition overwrite. On ``local[n]`` the default of 200 shuffle partitions is only overhead, so an untouched
    default is lowered to the core count. On a cluster the configured width is kept. A session that has chosen its
    own state store keeps that and its memory.
    """
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider).endswith(("HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider")):
        for key, value in STREAM_SETTINGS.items():
            spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies in the shared folder that the cluster names in ``spark.checkpoint.dir``; where that is
    unset, as in tests, in the session's warehouse. Never in a temporary folder of one machine. The
    caller owns the folder and may delete it when its tables are no longer read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
