"""Replay of the given events as a click log that arrives in three parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import work_folder
from clickweave.sources import star_schema
from clickweave.sources.streams import text_lines
from clickweave.streaming.ad_monitor import CATCH_UP, AdMonitor

# First days of the second and the third part.
PART_STARTS = ("2024-01-11", "2024-01-21")

# A replay reads files in any order, so no row may be late within it.
WHOLE_LOG = "60 days"


def replay(spark: SparkSession, sf_dir: str, threshold: int) -> AdMonitor:
    """Per part: write its lines, filter them, count users. Each step is a restarted query.

    Lines of `error` events are cut short, so the log holds lines to reject.
    """
    root = work_folder(spark, "ad-replay")
    monitor = AdMonitor(spark, root, threshold, day_late_by=WHOLE_LOG, minute_late_by=WHOLE_LOG)
    monitor.create_tables()
    for part in _parts(spark, sf_dir):
        _filter(monitor, part)
        monitor.start_user_clicks(CATCH_UP).awaitTermination()
    return monitor


def replay_late(spark: SparkSession, sf_dir: str) -> AdMonitor:
    """Filter the second and the third part, then the first, with the usual lateness."""
    monitor = AdMonitor(spark, work_folder(spark, "ad-late")).create_tables()
    first, second, third = _parts(spark, sf_dir)
    for part in (second, third, first):
        _filter(monitor, part)
    return monitor


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    lines = star_schema.ad_lines(spark, sf_dir, broken_errors=True)
    first, second = (F.lit(day).cast("date") for day in PART_STARTS)
    day = F.col("logged_on")
    return [lines.where(part).select("value")
            for part in (day < first, (day >= first) & (day < second), day >= second)]


def _filter(monitor: AdMonitor, lines: DataFrame) -> None:
    folder = monitor.path("lines")
    lines.write.mode("append").text(folder)
    monitor.start_filter(text_lines(monitor.spark, folder), CATCH_UP).awaitTermination()
