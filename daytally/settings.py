"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "daytally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Days and hours are cut in the session time zone, so fix it."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session with stream settings, leaving the caller's untouched.

    The number of state partitions is fixed for the life of a stream's
    checkpoint. Unless given, it is the cluster's default parallelism.
    """
    child = spark.newSession()
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    child.conf.set("spark.sql.shuffle.partitions", str(partitions))
    child.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return child


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="daytally-")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/daytally-{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable where the session names no folder."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
