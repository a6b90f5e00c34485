from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickweave.operators import sessions
from clickweave.params import TaskParams
from clickweave.sources.tables import actions_in_range
from tests.tables import action, actions, tuples, user, users


@pytest.fixture(scope="module")
def log(spark):
    return actions(
        spark,
        action(1, "a", 5, keyword="ab", page_id=1),
        action(2, "a", 0, keyword="a", page_id=2),
        action(3, "a", 45, click=44, product=7),
        action(4, "a", 45, click=4, product=7),
        action(5, "a", 50, click=44, product=8),
        action(6, "b", 3, user_id=2, keyword=""),
        action(7, "c", 3, user_id=3, click=9),
        action(8, "d", 3, user_id=99, click=9))


@pytest.fixture(scope="module")
def people(spark):
    return users(spark, user(1, 20, "doctor", "x", "male"), user(2, 50, "nurse", "y", "female"),
                 user(3, 51, "doctor", "y", "female"), user(4))


def test_aggregate(log):
    rows = {r["session_id"]: r for r in sessions.session_aggregate(log).collect()}
    a = rows["a"]
    assert (a["user_id"], a["visit_length"], a["step_length"]) == (1, 50, 5)
    # Values inside other values are kept, repeated ones are not.
    assert a["keywords"] == ["a", "ab"]
    assert a["categories"] == [4, 44]
    assert rows["b"]["keywords"] == [] and rows["b"]["visit_length"] == 0


def test_sessions_of_unknown_users_are_dropped(log, people):
    info = sessions.session_full_info(sessions.session_aggregate(log), people)
    assert tuples(info, "session_id", "age") == [("a", 20), ("b", 50), ("c", 51)]


@pytest.mark.parametrize("conditions, expected", [
    ({}, "abc"),
    ({"startAge": 20, "endAge": 50}, "ab"),
    ({"startAge": 30}, "abc"),
    ({"endAge": 30}, "abc"),
    ({"startAge": "", "endAge": 10}, "abc"),
    ({"professionals": "doctor,pilot"}, "ac"),
    ({"cities": "y"}, "bc"),
    ({"sex": "female"}, "bc"),
    ({"sex": ""}, "abc"),
    ({"keywords": "a"}, "a"),
    ({"keywords": "b"}, ""),
    ({"keywords": "zz,ab"}, "a"),
    ({"categoryIds": "9"}, "c"),
    ({"categoryIds": "4,5"}, "a"),
    ({"categoryIds": "-1"}, ""),
    ({"professionals": "doctor", "categoryIds": "9,44", "sex": "male"}, "a"),
])
def test_filters(log, people, conditions, expected):
    params = TaskParams.from_mapping(conditions)
    info = sessions.session_full_info(sessions.session_aggregate(log), people)
    kept = sessions.filter_sessions(info, params)
    assert "".join(s for s, in tuples(kept, "session_id")) == expected
    columns = ["session_id", "user_id", "start_time", "visit_length", "step_length", "age"]
    assert tuples(sessions.matching_sessions(log, people, params), *columns) \
        == tuples(kept, *columns)


def test_missing_user_data_fails_its_filter(spark, log):
    people = users(spark, user(1, None, None, None, None))
    for conditions in ({"startAge": 0, "endAge": 100}, {"sex": "male"}, {"cities": "x"}):
        params = TaskParams.from_mapping(conditions)
        assert sessions.matching_sessions(log, people, params).count() == 0
    assert sessions.matching_sessions(log, people, TaskParams()).count() == 1


def test_actions_of_sessions(log, people):
    kept = sessions.matching_sessions(log, people, TaskParams(sex="male"))
    assert tuples(sessions.filtered_actions(log, kept), "event_id") == [(i,) for i in range(1, 6)]


def test_date_range_includes_both_ends(spark):
    rows = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 11)], "date STRING")
    assert tuples(actions_in_range(rows, "2024-01-03", "2024-01-04")) \
        == [("2024-01-03",), ("2024-01-04",)]
    assert actions_in_range(rows, None, "2024-01-04").count() == 4
    assert actions_in_range(rows, "2024-01-03", None).count() == 8


def test_bands_and_ratios(spark):
    lengths = [(0, 1), (2, 3), (3, 4), (10, 31), (45, 60), (1801, 61), (1, 61)]
    rows = spark.createDataFrame(lengths, "visit_length BIGINT, step_length BIGINT")
    counts = sessions.band_counts(rows)
    row = counts.first()
    assert row["session_count"] == 7
    assert [row[f"visit_length_{b}"] for b in ("1s_3s", "10s_30s", "30s_60s", "30m")] == [3, 1, 1, 1]
    assert [row[f"step_length_{b}"] for b in ("1_3", "4_6", "30_60", "60")] == [2, 1, 2, 2]
    # A length of 0 is in no band but in the total.
    assert sum(row[c] for c in counts.columns if c.startswith("visit")) == 6
    assert sum(row[c] for c in counts.columns if c.startswith("step")) == 7
    ratios = sessions.band_ratios(counts).first()
    assert ratios["visit_length_1s_3s_ratio"] == 0.43
    assert ratios["step_length_60_ratio"] == 0.29


def test_ratios_without_sessions(spark):
    rows = spark.createDataFrame([], "visit_length BIGINT, step_length BIGINT")
    row = sessions.band_ratios(sessions.band_counts(rows)).first()
    assert row["session_count"] == 0
    assert set(row) == {0, 0.0}


def test_user_of_a_session_does_not_depend_on_order(spark):
    log = actions(spark, action(1, "a", user_id=8), action(2, "a", user_id=5))
    for rows in (log, log.orderBy(F.desc("event_id"))):
        assert sessions.session_aggregate(rows).first()["user_id"] == 5
