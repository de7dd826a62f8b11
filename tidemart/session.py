"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Days and hours are cut in UTC. Joins on
# a hot key are split by AQE even when the split costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join whose shuffled partitions all turn out small is hashed, not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Files hold compressed columns: count them four times as large when a side's
    # size is checked for a broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # One store per join partition instead of four, no read before each write to count rows, one memory bound for all
    # stores of an executor.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1024",
    # A batch writes down what it changed in a store; whole stores are put by in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A restart needs the last batch's stores, and the one before if that was cut off; older files go, and with them the
    # local copies of runs that have ended, every quarter of a minute.
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
}

PARTITIONS = "spark.sql.shuffle.partitions"


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if not spark.sparkContext.getConf().contains(PARTITIONS):
        spark.conf.set(PARTITIONS, str(_default_partitions(spark)))
    return spark


def _default_partitions(spark: SparkSession) -> int:
    """Shuffle partitions where the session sets none: three per core on a cluster
    (AQE joins small ones), one per core on a single machine. State stores keep the
    number of their first run."""
    sc = spark.sparkContext
    return sc.defaultParallelism if sc.master.startswith("local") else max(200, 3 * sc.defaultParallelism)


def drop_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files no plan refers to any more. Spark finds them when the driver collects its garbage,
    which one with memory to spare may not do before the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only when the session names none and runs on one machine (tests) a local one is
    made and set, so that later calls and `checkpoint()` use the same.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") \
        or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemart-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def new_workdir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's topics, tables and checkpoints."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
