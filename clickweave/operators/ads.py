"""Ad clicks. The same functions serve batches and streams.

Clicks have ts, province, city, user_id, ad_id. `late_by` sets the watermark of a stream: how far
behind the newest day (or minute) a row may be before its group is closed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.dates import day_key, from_epoch_ms
from clickweave.operators.joins import keys_to_match

# Milliseconds since 1970 that a timestamp can hold, whose unit is the microsecond.
MAX_MILLISECONDS = (2**63 - 1) // 1000


def _number(text: Column) -> Column:
    """A whole number within the range of BIGINT, else null."""
    return F.when(text.rlike(r"^-?[0-9]+$"), text.try_cast("bigint"))


def _name(text: Column) -> Column:
    """A part that is not empty and free of other white space, else null."""
    return F.when(text.rlike(r"^\S+$"), text)


def parsed_lines(lines: DataFrame) -> DataFrame:
    """`epoch_ms province city user ad` lines with `field`: each part typed, null if it is wrong.

    Parts are one space apart; those after the fifth are ignored. Each step is a generator of one
    row, below which no filter is pushed: a line is split once and a part matched and cast once,
    whatever conditions and columns are made of them.
    """
    split = lines.select("*", F.explode(F.array(F.split("value", " "))).alias("part"))
    part = [F.get("part", F.lit(i)) for i in range(5)]
    field = F.struct(
        _number(part[0]).alias("time"), _name(part[1]).alias("province"),
        _name(part[2]).alias("city"), _number(part[3]).alias("user_id"),
        _number(part[4]).alias("ad_id"))
    return split.select(*lines.columns, F.explode(F.array(field)).alias("field"))


def _is_click() -> Column:
    """Whether all fields are there and the time is one that a timestamp can hold."""
    in_range = F.col("field.time").between(-MAX_MILLISECONDS, MAX_MILLISECONDS)
    there = [F.col(f"field.{name}").isNotNull() for name in ("province", "city", "user_id", "ad_id")]
    return reduce(Column.__and__, there, F.coalesce(in_range, F.lit(False)))


def clicks_of(parsed: DataFrame) -> DataFrame:
    """The clicks among parsed lines."""
    others = [c for c in parsed.columns if c not in ("value", "field")]
    return parsed.where(_is_click()).select(
        *others, from_epoch_ms(F.col("field.time")).alias("ts"), "field.province", "field.city",
        "field.user_id", "field.ad_id")


def rejects_of(parsed: DataFrame) -> DataFrame:
    """The parsed lines that are no click, as they came."""
    return parsed.where(~_is_click()).drop("field")


def valid_clicks(lines: DataFrame) -> DataFrame:
    """The lines that are clicks, split and typed."""
    return clicks_of(parsed_lines(lines))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no click, kept as they came."""
    return rejects_of(parsed_lines(lines))


def _per_day(clicks: DataFrame, keys: list[str], late_by: str | None) -> DataFrame:
    """Clicks per day of the session time zone and further keys."""
    dated = clicks.withColumn("day", F.date_trunc("day", "ts"))
    if late_by is not None:
        dated = dated.withWatermark("day", late_by)
    counts = dated.groupBy("day", *keys).agg(F.count("*").alias("click_count"))
    return counts.select(day_key(F.col("day")).alias("date"), *keys, "click_count")


def is_closed(unit: str, newest: Column, late_by: str) -> Column:
    """Whether a watermark of `late_by` on the click's day or minute has passed it."""
    start, end = (F.unix_micros(F.date_trunc(unit, ts)) for ts in (F.col("ts"), newest))
    delay = F.expr(f"unix_micros(TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {late_by})")
    return start <= end - delay


def user_clicks(clicks: DataFrame, late_by: str | None = None) -> DataFrame:
    """Clicks per day, user and ad."""
    return _per_day(clicks, ["user_id", "ad_id"], late_by)


def city_clicks(clicks: DataFrame, late_by: str | None = None) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return _per_day(clicks, ["province", "city", "ad_id"], late_by)


def province_day_clicks(clicks: DataFrame, late_by: str | None = None) -> DataFrame:
    """Clicks per day, province and ad, counted from the clicks themselves."""
    return _per_day(clicks, ["province", "ad_id"], late_by)


def blacklisted_users(counts: DataFrame, threshold: int = 100) -> DataFrame:
    """Users with more clicks on one ad in one day than the threshold."""
    return counts.where(F.col("click_count") > threshold).select("user_id").distinct()


def without_users(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not listed."""
    return clicks.join(keys_to_match(blacklist, "user_id"), "user_id", "left_anti")


def province_clicks(per_city: DataFrame) -> DataFrame:
    """Clicks per day, province and ad, summed over cities."""
    return (per_city.groupBy("date", "province", "ad_id")
            .agg(F.sum("click_count").alias("click_count")))


def province_top(per_province: DataFrame, size: int = 3) -> DataFrame:
    """The most clicked ads of each day and province, ties by ad id."""
    order = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), "ad_id")
    return (per_province.withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= size).drop("position"))


def minute_clicks(clicks: DataFrame, late_by: str | None = None) -> DataFrame:
    """Clicks per minute and ad."""
    timed = clicks.withColumn("time", F.date_trunc("minute", "ts"))
    if late_by is not None:
        timed = timed.withWatermark("time", late_by)
    return timed.groupBy("time", "ad_id").agg(F.count("*").alias("click_count"))


def minute_trend(per_minute: DataFrame) -> DataFrame:
    """The minute as date, hour and minute keys."""
    return per_minute.select(day_key(F.col("time")).alias("date"),
                             F.date_format("time", "HH").alias("hour"),
                             F.date_format("time", "mm").alias("minute"),
                             "ad_id", "click_count")


def recent_clicks(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks of the given number of minutes up to the newest one.

    The bound is a scalar compared with `ts` itself, so it reaches the scan before any counting.
    """
    newest = F.date_trunc("minute", F.max("ts"))
    since = newest - F.make_dt_interval(mins=F.lit(minutes - 1))
    bound = clicks.agg(since.cast(clicks.schema["ts"].dataType)).scalar()
    return clicks.where(F.col("ts") >= bound)
