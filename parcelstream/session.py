"""Session construction and checkpoint-directory policy."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  The session zone is pinned to UTC: all
# local-time rendering goes through an explicit zone parameter instead.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Settings for the 100 TB target, applied by ``configure_for_scale`` only
# where the cluster has not set them: partitions are sized by bytes (AQE
# coalesces small ones and splits skewed ones), file splits stay at 256 MB
# so a scan task fits in executor memory, and broadcasts stay well under
# driver/executor memory.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Stateful streaming fixes its state partitions at the first start (one
# state store per partition), so it gets a moderate count of its own.
STREAM_SHUFFLE_PARTITIONS = "400"


def configure_for_scale(spark: SparkSession, overrides: dict | None = None,
                        streaming: bool = False) -> None:
    """Apply ``SCALE_CONF`` (plus ``overrides``) to keys the cluster left
    unset; explicit cluster settings always win.  Local masters keep their
    core-sized partition count."""
    conf = dict(SCALE_CONF, **(overrides or {}))
    if streaming:
        conf["spark.sql.shuffle.partitions"] = STREAM_SHUFFLE_PARTITIONS
    if spark.sparkContext.master.startswith("local"):
        conf.pop("spark.sql.shuffle.partitions", None)
    sc_conf = spark.sparkContext.getConf()
    for k, v in conf.items():
        if not sc_conf.contains(k):
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static confs are set at launch
                pass
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "parcelstream", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's own session and
    only make sure ``BASE_CONF`` is applied."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def open_writers(spark: SparkSession, most: int = 64):
    """Writes partitioned by a column of few values keep one file open per value
    instead of sorting each task's rows by it (beyond ``most`` they sort)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session without one (tests, the bench) gets a fresh scratch folder; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="parcelstream-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
