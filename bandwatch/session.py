"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the plans count on. Broadcasting is left to
# spark.sql.autoBroadcastJoinThreshold: a rule table that outgrows it is
# shuffled, and the skew settings then split hot join keys.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # tables stored by slot and element are joined on more columns without moving rows
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # streaming state on disk, so that it may outgrow an executor's memory
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive plans inside, for work on a batch of a stateful stream: Spark turns them off in its session, and rebalance hints with them.

    The batch itself is planned before its function is called, so its state keeps its partitions.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def work_root(spark: SparkSession) -> str:
    """Folder for written tables and stream checkpoints, shared by all executors: spark.checkpoint.dir.

    Only a local session, all of whose tasks run on this machine, may go without and gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="bandwatch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{work_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def parallelism(spark: SparkSession) -> int:
    """Partition count for compute-heavy stages that must not be coalesced."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
