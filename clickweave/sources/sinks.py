"""Result tables.

Batch results are appended under the caller's task id. Results of streams are written per
micro-batch below `batch_id=<n>`: a replayed batch overwrites its own folder, so totals and latest
values stay right after a restart.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_task_id(result: DataFrame, task_id: str) -> DataFrame:
    """The result with the task id as its first column."""
    return result.select(F.lit(task_id).alias("taskid"), "*")


def append_result(result: DataFrame, path: str, task_id: str) -> None:
    """Write a task's result below its task id; running the task again replaces only its rows.

    The task's folder is written as a whole: a result that is empty now leaves no earlier rows, and
    a first one that is empty can be read.
    """
    folder = f"{path}/taskid={quote(task_id, safe='')}"
    result.hint("rebalance").write.mode("overwrite").parquet(folder)


def append_jdbc(result: DataFrame, url: str, table: str, task_id: str,
                properties: dict[str, str], connections: int = 10) -> None:
    """Append to a database table with at most `connections` writers."""
    (with_task_id(result, task_id).coalesce(connections)
     .write.mode("append").jdbc(url, table, properties=properties))


def replace_table(result: DataFrame, name: str, path: str | None = None) -> None:
    """Drop a catalog table and save the result under its name, in the given folder if any."""
    writer = result.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create_table(spark: SparkSession, path: str, schema: str,
                 partition_by: Sequence[str]) -> None:
    """Make the folder of a partitioned table if it does not exist yet."""
    (spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partition_by)
     .parquet(path))


def create_batches(spark: SparkSession, path: str, schema: str,
                   partition_by: Sequence[str] = ()) -> None:
    """Make the folder of a per-batch table if it does not exist yet."""
    create_table(spark, path, f"{schema}, batch_id BIGINT", [*partition_by, "batch_id"])


def write_batch(rows: DataFrame, path: str, batch_id: int,
                partition_by: Sequence[str] = ()) -> None:
    """Write the rows of one micro-batch; a replay replaces what it wrote before."""
    _overwrite_partitions(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path,
                          [*partition_by, "batch_id"])


def _overwrite_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions present in the rows.

    Rebalancing by partition keeps a folder from getting a small file of every task, while AQE
    still splits a partition that is large.
    """
    (rows.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a per-batch table as they are now (the files are listed at each call)."""
    return spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)


def latest(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwriting upsert: per key the values of its newest batch."""
    values = [c for c in batches.columns if c not in (*keys, "batch_id")]
    newest = [F.max_by(c, "batch_id").alias(c) for c in values]
    return batches.groupBy(*keys).agg(*newest)


def summed(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adding upsert: per key the sum over its batches."""
    values = [c for c in batches.columns if c not in (*keys, "batch_id")]
    return batches.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def replace_groups(rows: DataFrame, path: str, groups: Sequence[str]) -> None:
    """Replace whole groups: those present in the rows, no others."""
    _overwrite_partitions(rows, path, groups)


def compact(batches: DataFrame, path: str, keys: Sequence[str], batch_id: int, *,
            adding: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Write the state up to a batch as one batch of a new table, which then takes later ones."""
    done = batches.where(F.col("batch_id") <= batch_id)
    state = summed(done, keys) if adding else latest(done, keys)
    write_batch(state, path, batch_id, partition_by)
