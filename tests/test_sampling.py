from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest

from clickweave.operators import sampling
from tests.tables import DAY, action, actions, tuples


def sessions_at(spark, per_hour: dict[tuple[int, int], int]):
    """Sessions by (day, hour)."""
    rows = [(f"s{d}-{h}-{i}", DAY + timedelta(days=d, hours=h, seconds=i))
            for (d, h), n in per_hour.items() for i in range(n)]
    return spark.createDataFrame(rows, "session_id STRING, start_time TIMESTAMP_NTZ")


def quotas(rows, size):
    found = sampling.hour_quota(sampling.hour_counts(rows), size).collect()
    return {(r["date"].day - DAY.day, r["hour"]): r["hour_quota"] for r in found}


def test_quota_is_shared_out_in_whole_numbers(spark):
    rows = sessions_at(spark, {(0, 1): 30, (0, 2): 60, (0, 3): 10, (1, 5): 7})
    # 101 for two days is 50 a day; an hour gets its part, at most what it has.
    assert quotas(rows, 101) == {(0, 1): 15, (0, 2): 30, (0, 3): 5, (1, 5): 7}


def test_quota_rounds_down_to_nothing(spark):
    rows = sessions_at(spark, {(0, 1): 1, (0, 2): 99})
    assert quotas(rows, 50) == {(0, 1): 0, (0, 2): 49}
    many_days = sessions_at(spark, {(d, 1): 2 for d in range(5)})
    assert set(quotas(many_days, 4).values()) == {0}
    assert sampling.sample_sessions(many_days, 4).count() == 0


def test_sample_fills_every_quota_without_repeats(spark):
    per_hour = {(0, 1): 30, (0, 2): 60, (0, 3): 10, (1, 5): 7}
    rows = sessions_at(spark, per_hour)
    drawn = [s for s, in tuples(sampling.sample_sessions(rows, 100), "session_id")]
    assert len(set(drawn)) == len(drawn)
    assert set(drawn) <= {s for s, in tuples(rows, "session_id")}
    assert Counter(s.rsplit("-", 1)[0] for s in drawn) == {
        "s0-1": 15, "s0-2": 30, "s0-3": 5, "s1-5": 7}


def test_sample_follows_the_seed(spark):
    rows = sessions_at(spark, {(0, 1): 40})
    drawn = [tuples(sampling.sample_sessions(rows, 10, seed)) for seed in ("a", "a", "b")]
    assert drawn[0] == drawn[1] != drawn[2]


def test_sample_of_nothing(spark):
    assert sampling.sample_sessions(sessions_at(spark, {}), 100).count() == 0


@pytest.mark.parametrize("size", [1, 10_000_000])
def test_report_and_detail(spark, size):
    log = actions(spark, action(1, "a", 0, keyword="y"), action(2, "a", 9, keyword="x", click=3),
                  action(3, "a", 9, click=12), action(4, "b", 0, keyword="z"))
    sample = spark.createDataFrame([("a", DAY)], "session_id STRING, start_time TIMESTAMP_NTZ")
    assert tuples(sampling.sample_report(sample, log, size)) == [
        ("a", "2024-01-10 00:00:00", "x,y", "3,12")]
    detail = sampling.sample_detail(sample, log, size)
    assert tuples(detail, "session_id", "action_time", "click_category_id") == [
        ("a", "2024-01-10 00:00:00", -1), ("a", "2024-01-10 00:00:09", 3),
        ("a", "2024-01-10 00:00:09", 12)]
    assert datetime.strptime(detail.first()["action_time"], "%Y-%m-%d %H:%M:%S")
