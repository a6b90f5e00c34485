"""Sources of the ad click log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_lines(spark: SparkSession, brokers: str, topic: str,
                starting_offsets: str = "latest", **options: str) -> DataFrame:
    """Message texts of one topic, as `value`; needs Spark's Kafka connector on the classpath.

    Offsets live in the query's checkpoint; `starting_offsets` counts for the first start only.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .options(**options)
            .load()
            .selectExpr("CAST(value AS STRING) AS value"))


def text_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files arriving in a folder, as `value`."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)
