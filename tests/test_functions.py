from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickweave.functions import dates, labels, numbers, text


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("written, expected", [
    ("2024-01-05 7:08:09", datetime(2024, 1, 5, 7, 8, 9)),
    ("2024-01-05 17:08:09", datetime(2024, 1, 5, 17, 8, 9)),
    ("yesterday noon", None),
    ("", None),
])
def test_parse_time(spark, written, expected):
    assert value(spark, dates.parse_time(F.lit(written))) == expected


def test_time_keys(spark):
    time = dates.parse_time(F.lit("2024-01-05 7:08:09"))
    assert value(spark, dates.format_time(time)) == "2024-01-05 07:08:09"
    assert value(spark, dates.format_date(time)) == "2024-01-05"
    assert value(spark, dates.date_hour_key(time)) == "2024-01-05_07"
    assert value(spark, dates.minute_key(time)) == "202401050708"
    assert value(spark, dates.parse_day_key(F.lit("20240105"))) == date(2024, 1, 5)
    assert value(spark, dates.parse_day_key(F.lit("2024-x"))) is None


def test_day_key_follows_the_session_time_zone(spark):
    key = dates.day_key(dates.from_epoch_ms(F.lit(1704412800000 - 1)))
    assert value(spark, key) == "20240104"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert value(spark, key) == "20240105"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_order_and_distance_of_times(spark):
    first, second = (dates.parse_time(F.lit(f"2024-01-05 10:00:{s}")) for s in ("05", "47"))
    assert value(spark, dates.is_before(first, second)) is True
    assert value(spark, dates.is_after(first, second)) is False
    assert value(spark, dates.seconds_between(first, second)) == 42


def test_today_and_yesterday(spark):
    row = spark.range(1).select(
        F.datediff(dates.today().cast("date"), dates.yesterday().cast("date")).alias("days"),
        (dates.today() == F.current_date().cast("string")).alias("is_today")).first()
    assert tuple(row) == (1, True)


@pytest.mark.parametrize("number, scale, expected", [
    (0.145, 2, 0.15), (0.144, 2, 0.14), (29 / 200, 2, 0.15), (2.5, 0, 3.0), (-0.145, 2, -0.15),
])
def test_round_half_up(spark, number, scale, expected):
    assert value(spark, numbers.round_half_up(F.lit(number), scale)) == expected


def test_share_of_nothing_is_zero(spark):
    assert value(spark, numbers.share(F.lit(0), F.lit(0))) == 0.0
    assert value(spark, numbers.share(F.lit(1), F.lit(3))) == 0.33


@pytest.mark.parametrize("written, expected", [
    ("3,12,7", [3, 12, 7]), ("5", [5]), ("4, 6", [4, 6]), ("1,x,2", [1, 2]), (None, None),
])
def test_id_list(spark, written, expected):
    assert value(spark, text.id_list(F.lit(written))) == expected


def test_joined_lists(spark):
    assert value(spark, text.join_sorted(F.array(F.lit(10), F.lit(9)))) == "9,10"
    assert value(spark, text.join_list(F.array().cast("array<string>"))) is None


@pytest.mark.parametrize("written, expected", [
    (",a,b,", "a,b"), ("a,", "a"), (",a", "a"), ("a", "a"), ("", ""),
])
def test_trim_comma(spark, written, expected):
    assert value(spark, text.trim_comma(F.lit(written))) == expected


def test_empty_text(spark):
    for written, empty in ((None, True), ("", True), ("x", False)):
        assert value(spark, text.is_empty(F.lit(written))) is empty
        assert value(spark, text.is_not_empty(F.lit(written))) is not empty


@pytest.mark.parametrize("written, expected", [("7", "07"), ("17", "17"), ("123", "0123")])
def test_pad2(spark, written, expected):
    assert value(spark, text.pad2(F.lit(written))) == expected


def test_record_fields(spark):
    record = F.lit("a=1|b=|c=x=y|d=4")
    assert value(spark, text.get_field(record, "a")) == "1"
    assert value(spark, text.get_field(record, "d")) == "4"
    for absent in ("b", "c", "e"):
        assert value(spark, text.get_field(record, absent)) is None
    assert value(spark, text.set_field(record, "d", F.lit("9"))) == "a=1|b=|c=x=y|d=9"


def test_concat_and_group_concat(spark):
    assert value(spark, text.concat_long_string(F.lit(1), F.lit("上海"), ":")) == "1:上海"
    rows = spark.createDataFrame([("b",), ("ab",), ("b",), (None,)], "t STRING")
    # A value inside another one is kept.
    assert rows.agg(text.group_concat_distinct(F.col("t"))).first()[0] == "ab,b"


@pytest.mark.parametrize("info, expected", [
    ('{"product_status": 0}', "Self"), ('{"product_status": "0"}', "Self"),
    ('{"product_status": 1}', "Third Party"), ("{}", "Third Party"), (None, "Third Party"),
])
def test_product_status(spark, info, expected):
    assert value(spark, labels.product_status(F.lit(info))) == expected


@pytest.mark.parametrize("area, level", [
    ("华北", "A_Level"), ("华东", "A_Level"), ("华中", "B_Level"), ("华南", "B_Level"),
    ("西南", "C_Level"), ("西北", "C_Level"), ("东北", "D_Level"), (None, "D_Level"),
])
def test_area_level(spark, area, level):
    assert value(spark, labels.area_level(F.lit(area))) == level


def test_bands(spark):
    seconds = {0: None, 1: "1s_3s", 3: "1s_3s", 4: "4s_6s", 9: "7s_9s", 10: "10s_30s",
               30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 61: "1m_3m", 180: "1m_3m",
               181: "3m_10m", 600: "3m_10m", 601: "10m_30m", 1800: "10m_30m", 1801: "30m"}
    steps = {1: "1_3", 3: "1_3", 4: "4_6", 7: "7_9", 10: "10_30", 30: "10_30", 31: "30_60",
             60: "30_60", 61: "60", 1000: "60"}
    for number, name in seconds.items():
        assert value(spark, labels.visit_band(F.lit(number))) == name
    for number, name in steps.items():
        assert value(spark, labels.step_band(F.lit(number))) == name
