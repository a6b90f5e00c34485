from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickweave.operators import funnel
from tests.tables import action, actions, tuples


def next_pages(rows):
    """Pairs of pages by brute force."""
    by_session = defaultdict(list)
    for event_id, _, _, session_id, page_id, time, *_ in rows:
        by_session[session_id].append((time, event_id, page_id))
    pairs = Counter()
    for visits in by_session.values():
        pages = [page for *_, page in sorted(visits)]
        pairs.update(zip(pages, [*pages[1:], None]))
    return pairs


def found_pages(transitions):
    rows = transitions.groupBy("page_id", "next_page_id").count().collect()
    return Counter({(r["page_id"], r["next_page_id"]): r["count"] for r in rows})


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(visits=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 4000),
                                 st.integers(1, 5)), min_size=1, max_size=60),
       minutes=st.sampled_from([1, 10, 100]),
       zone=st.sampled_from(["UTC", "America/New_York"]))
def test_transitions_are_those_of_whole_sessions(spark, visits, minutes, zone):
    # On this day New York's clocks skip the hour from two o'clock.
    day = datetime(2024, 3, 10, 1, 30)
    rows = [action(i, s, second, page_id=page, day=day)
            for i, (s, second, page) in enumerate(visits)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        transitions = funnel.page_transitions(actions(spark, *rows), minutes)
        assert found_pages(transitions) == next_pages(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_transitions_gather_nothing_in_one_task(spark):
    """But for the count of the fullest slice, of which each task sends the greatest it has."""
    plan = funnel.page_transitions(actions(spark, action(1, "s"))).select("page_id")
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [after for line, after in zip(lines, lines[1:]) if "SinglePartition" in line]
    assert all("HashAggregate(keys=[], functions=[partial_max(" in line for line in below)


def test_a_session_holding_most_of_the_log(spark):
    rows = [action(i, "hot" if i % 3 else f"s{i}", i * 7 % 20_000, page_id=i % 9)
            for i in range(3000)]
    log = actions(spark, *rows)
    transitions = funnel.page_transitions(log)
    assert transitions.count() == 3000
    assert found_pages(transitions) == next_pages(rows)


def test_a_third_of_the_log_in_one_slice(spark):
    """Rows without a session, all within ten minutes: no slice holds more than its share of them."""
    rows = [action(i, None if i % 3 == 0 else f"s{i % 50}", i % 600 if i % 3 == 0 else i * 61,
                   page_id=i % 7) for i in range(3000)]
    log = actions(spark, *rows)
    sizes = [r["count"] for r in funnel.in_slices(log, slice_rows=100).groupBy(
        "session_id", "slice").count().collect()]
    assert max(sizes) <= 110 and sum(sizes) == 3000
    assert found_pages(funnel.page_transitions(log, slice_rows=100)) == next_pages(rows)
    # Without such a slice they are ten minutes long.
    calm = funnel.in_slices(actions(spark, *rows[1:40]))
    assert {r["slice"] for r in calm.collect()} == {r["slice"] for r in funnel.in_slices(
        actions(spark, *rows[1:40]), slice_rows=10**9).collect()}


def test_equal_times_go_by_event_or_by_page(spark):
    log = actions(spark, action(2, "a", 5, page_id=1), action(1, "a", 5, page_id=2))
    assert tuples(funnel.page_transitions(log).where("next_page_id is not null")) == [("a", 2, 1)]
    without_id = funnel.page_transitions(log.drop("event_id"))
    assert tuples(without_id.where("next_page_id is not null")) == [("a", 1, 2)]


@pytest.fixture(scope="module")
def counts(spark):
    # Session a: 1 2 3 1 2, session b: 1 2, session c: 3 1.
    visits = [("a", 1), ("a", 2), ("a", 3), ("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 3),
              ("c", 1)]
    log = actions(spark, *[action(i, s, i, page_id=p) for i, (s, p) in enumerate(visits)])
    return lambda flow: funnel.transition_counts(funnel.page_transitions(log), flow)


def test_conversion(counts):
    # The first base is all views of the start page, the next ones the step before.
    rows = funnel.page_conversion(counts((1, 2, 3))).collect()
    assert [tuple(r) for r in rows] == [(1, "1_2", 3, 3 / 4), (2, "2_3", 1, 1 / 3)]


def test_steps_never_made_and_repeated_steps(counts):
    rows = funnel.page_conversion(counts((1, 3, 2, 1, 3))).collect()
    assert [tuple(r) for r in rows] == [
        (1, "1_3", 0, 0.0), (2, "3_2", 0, None), (3, "2_1", 0, None), (4, "1_3", 0, None)]


def test_conversion_text(counts):
    conversion = funnel.page_conversion(counts((1, 2, 3, 9)))
    assert funnel.conversion_text(conversion).first()[0] \
        == "1_2=0.75|2_3=0.3333333333333333|3_9=0.0"
    assert funnel.conversion_text(conversion, 2).first()[0] == "1_2=0.75|2_3=0.33|3_9=0.00"
