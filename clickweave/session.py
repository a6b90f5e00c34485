"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Shuffle partition counts are left to the cluster: AQE starts
# from `initialPartitionNum` and merges small partitions up to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Join by hash instead of by sort where every partition of one side is that small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Noting the Python line of every column takes longer than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Closed groups can wait for the next data to be dropped. Only saves time: nothing relies on it.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(app_name: str = "clickweave", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder named by the cluster.

    Without `spark.checkpoint.dir` a local session falls back to a temporary folder; any other
    master is refused, because executors could not see each other's files there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="clickweave-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
