"""Random sample of sessions, proportional to the sessions of each hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.dates import format_time
from clickweave.functions.text import join_list
from clickweave.operators.joins import broadcast_below
from clickweave.operators.sessions import session_aggregate

DETAIL_COLUMNS = (
    "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids",
)


def with_hour(sessions: DataFrame) -> DataFrame:
    return (sessions.withColumn("date", F.to_date("start_time"))
            .withColumn("hour", F.hour("start_time")))


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start."""
    return with_hour(sessions).groupBy("date", "hour").agg(F.count("*").alias("session_count"))


def hour_quota(counts: DataFrame, size: int) -> DataFrame:
    """How many sessions to draw from each hour.

    Every day gets the same whole number out of `size`; an hour gets its part of the day's,
    rounded down. The windows run over hours of the calendar, never over sessions.
    """
    days = F.size(F.collect_set("date").over(Window.partitionBy(F.lit(1))))
    in_day = F.sum("session_count").over(Window.partitionBy("date"))
    per_day = F.floor(F.lit(size) / F.col("days"))
    part = F.floor(F.col("session_count") / F.col("day_count") * per_day)
    return (counts.withColumn("days", days).withColumn("day_count", in_day)
            .select("date", "hour", "session_count", "day_count",
                    per_day.alias("day_quota"),
                    F.least(part, F.col("session_count")).alias("hour_quota")))


def sample_sessions(sessions: DataFrame, size: int = 100, seed: str = "0") -> DataFrame:
    """Draw each hour's quota without replacement, in the order of a seeded hash.

    No quota exceeds `size`, so the rank is first cut at that constant: Spark then drops the
    rest before the shuffle and an hour with very many sessions costs no task more than `size`
    rows per input partition.
    """
    quota = hour_quota(hour_counts(sessions), size).where("hour_quota > 0")
    order = Window.partitionBy("date", "hour").orderBy(
        F.md5(F.concat(F.lit(seed), F.col("session_id"))), "session_id")
    candidates = (with_hour(sessions).select("session_id", "start_time", "date", "hour")
                  .withColumn("position", F.row_number().over(order))
                  .where(F.col("position") <= size))
    return (candidates.join(quota.select("date", "hour", "hour_quota"), ["date", "hour"])
            .where(F.col("position") <= F.col("hour_quota"))
            .select("session_id", "start_time"))


def sample_actions(sample: DataFrame, actions: DataFrame, size: int) -> DataFrame:
    """Every action of the drawn sessions; the sample holds at most `size` rows."""
    drawn = broadcast_below(sample.select("session_id"), size)
    return actions.join(drawn, "session_id", "left_semi")


def sample_report(sample: DataFrame, actions: DataFrame, size: int) -> DataFrame:
    """Start, keywords and categories of the drawn sessions, the lists joined by commas."""
    drawn = session_aggregate(sample_actions(sample, actions, size))
    return drawn.select("session_id", format_time(F.col("start_time")).alias("start_time"),
                        join_list(F.col("keywords")).alias("search_keywords"),
                        join_list(F.col("categories")).alias("click_category_ids"))


def sample_detail(sample: DataFrame, actions: DataFrame, size: int) -> DataFrame:
    """The actions of the drawn sessions, one row each."""
    return (sample_actions(sample, actions, size).select(*DETAIL_COLUMNS)
            .withColumn("action_time", format_time(F.col("action_time"))))
