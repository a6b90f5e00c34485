from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from clickweave.operators import ads
from clickweave.session import work_folder
from clickweave.sources import files, star_schema
from clickweave.sources.batch_table import BatchTable
from clickweave.sources.streams import kafka_lines, text_lines
from clickweave.streaming import ad_monitor
from clickweave.streaming.ad_monitor import CATCH_UP, AdMonitor
from tests.tables import tuples

NOON = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)


# A click of the year 5138.
AHEAD = "100000000000000 p c 1 5"


def line(user_id, ad_id, minutes=0, province="p", city="c"):
    ms = int((NOON + timedelta(minutes=minutes)).timestamp() * 1000)
    return f"{ms} {province} {city} {user_id} {ad_id}"


@pytest.fixture
def root(spark):
    """A folder of its own; one state partition each is enough for a few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield work_folder(spark, "monitor")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def arrive(spark, root, *lines):
    (spark.createDataFrame([(text,) for text in lines], "value STRING").coalesce(1)
     .write.mode("append").text(f"{root}/lines"))


def run(spark, root, *queries, **options):
    """A new monitor over the same folder, as after a restart, brought up to date."""
    monitor = AdMonitor(spark, root, **options).create_tables()
    if "filter" in queries:
        monitor.start_filter(text_lines(spark, f"{root}/lines"), CATCH_UP).awaitTermination()
    # The counts run beside each other, as they do live.
    started = [getattr(monitor, f"start_{q}")(CATCH_UP) for q in queries if q != "filter"]
    for query in started:
        query.awaitTermination()
    return monitor


def test_blacklist_acts_from_the_next_batch(spark, root):
    arrive(spark, root, *[line(1, 5)] * 3, line(2, 5), "no click")
    monitor = run(spark, root, "filter", "user_clicks", threshold=2)
    assert tuples(monitor.blacklist()) == [(1,)]
    assert monitor.clean().count() == 4
    assert tuples(monitor.rejects()) == [("no click",)]

    arrive(spark, root, *[line(1, 6)] * 4, line(2, 5), line(2, 5))
    monitor = run(spark, root, "filter", "user_clicks", threshold=2)
    assert tuples(monitor.blacklist()) == [(1,), (2,)]
    # Earlier clicks of user 1 stay counted, later ones are gone; user 2 was not listed yet.
    assert tuples(monitor.user_clicks()) == [("20240110", 1, 5, 3), ("20240110", 2, 5, 3)]

    arrive(spark, root, line(2, 5), line(3, 5))
    monitor = run(spark, root, "filter", "user_clicks", threshold=2)
    assert tuples(monitor.clean(), "user_id") == [(1,)] * 3 + [(2,)] * 3 + [(3,)]


def test_late_clicks_count_until_their_day_is_closed(spark, root):
    day = 24 * 60
    arrive(spark, root, line(1, 5))
    run(spark, root, "filter", "ad_stat")
    arrive(spark, root, line(1, 5, day))
    run(spark, root, "filter", "ad_stat")
    arrive(spark, root, line(1, 5))
    monitor = run(spark, root, "filter", "ad_stat")
    assert tuples(monitor.ad_stat(), "date", "click_count") == [("20240110", 2), ("20240111", 1)]
    # The watermark a batch sets holds for late rows from the second batch after it.
    for _ in range(2):
        arrive(spark, root, line(1, 5, 2 * day))
        run(spark, root, "filter", "ad_stat")
    arrive(spark, root, line(1, 5), line(1, 5, day))
    monitor = run(spark, root, "filter", "ad_stat")
    assert tuples(monitor.ad_stat(), "date", "click_count") \
        == [("20240110", 2), ("20240111", 2), ("20240112", 2)]


def test_a_click_from_the_future_is_set_aside_and_counting_goes_on(spark, root):
    arrive(spark, root, line(1, 5), "100000000000000 p c 1 5", "no click")
    run(spark, root, "filter", "user_clicks", "ad_stat", threshold=2)
    for _ in range(3):
        arrive(spark, root, line(1, 5), line(2, 5))
        monitor = run(spark, root, "filter", "user_clicks", "ad_stat", threshold=2)
    assert tuples(monitor.out_of_time(), "user_id", "reason") == [(1, "ahead")]
    # User 1 is listed after three clicks, so the fourth is not counted.
    assert tuples(monitor.ad_stat(), "click_count") == [(6,)]
    assert tuples(monitor.blacklist()) == [(1,), (2,)]
    # Every line is somewhere: 9 in all, one of a listed user.
    parts = monitor.clean(), monitor.rejects(), monitor.out_of_time()
    assert [part.count() for part in parts] == [6, 1, 1]


def test_clicks_of_a_closed_day_or_minute_are_set_aside(spark, root):
    queries = "filter", "ad_stat", "click_trend"
    for minutes in (0, 90, 180):
        arrive(spark, root, line(1, 5, minutes))
        run(spark, root, *queries)
    # An hour behind the newest minute is closed, a minute later is not.
    arrive(spark, root, line(2, 5, 120), line(3, 5, 121), line(4, 5, -24 * 60 * 2))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.out_of_time(), "user_id", "reason") \
        == [(2, "minute_closed"), (4, "day_closed")]
    assert tuples(monitor.clean(), "user_id") == [(1,)] * 3 + [(2,), (3,)]
    assert tuples(monitor.ad_stat(), "click_count") == [(5,)]
    trend = monitor.click_trend().agg(F.sum("click_count")).first()[0]
    assert trend + 1 == monitor.clean().count()


def test_a_batch_updates_its_state_once(spark, root):
    arrive(spark, root, line(1, 5), line(1, 6))
    monitor = run(spark, root, "filter")
    query = monitor.start_province_top(CATCH_UP)
    query.awaitTermination()
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress
            if p["numInputRows"]] == [2]


@pytest.mark.parametrize("step, number", [
    ("write_text", 0), ("write_text", 2), ("write_text", 4), ("move", 1)])
def test_a_batch_of_the_filter_that_failed_counts_once(spark, root, monkeypatch, step, number):
    """Wherever it failed: before or after rejects, clean clicks or an inbox were published."""
    arrive(spark, root, line(1, 5), line(1, 5), "no click", AHEAD)
    with monkeypatch.context() as patch:
        fail_at(patch, files, step, number)
        with pytest.raises(StreamingQueryException):
            run(spark, root, "filter")
    run(spark, root, "user_clicks", "ad_stat")
    queries = "filter", "user_clicks", "ad_stat"
    run(spark, root, *queries)
    arrive(spark, root, line(2, 5))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.clean(), "user_id") == [(1,), (1,), (2,)]
    assert tuples(monitor.user_clicks(), "user_id", "click_count") == [(1, 2), (2, 1)]
    assert tuples(monitor.ad_stat(), "click_count") == [(3,)]
    assert tuples(monitor.rejects()) == [("no click",)]
    assert tuples(monitor.out_of_time(), "reason") == [("ahead",)]


@pytest.mark.parametrize("query, number", [("user_clicks", 0), ("user_clicks", 1), ("ad_stat", 1),
                                           ("province_top", 1), ("click_trend", 1)])
def test_a_batch_of_counts_that_failed_counts_once(spark, root, monkeypatch, query, number):
    """Before it was published, or after that and before its second output was."""
    arrive(spark, root, *[line(1, 5)] * 3, line(2, 5))
    run(spark, root, "filter", threshold=2)
    with monkeypatch.context() as patch:
        if number and query == "ad_stat":
            patch.setattr(BatchTable, "compact", fail)
        else:
            fail_at(patch, files, "write_text", number)
        with pytest.raises(StreamingQueryException):
            run(spark, root, query, threshold=2)
    for arrived in ((), (line(1, 5), line(3, 5), line(3, 6))):
        if arrived:
            arrive(spark, root, *arrived)
        monitor = run(spark, root, "filter", query, threshold=2)
    if query == "user_clicks":
        # User 1 was listed before the last lines came.
        assert tuples(monitor.blacklist()) == [(1,)]
        assert tuples(monitor.user_clicks(), "user_id", "ad_id", "click_count") == [
            (1, 5, 3), (2, 5, 1), (3, 5, 1), (3, 6, 1)]
    else:
        counts = {"ad_stat": monitor.ad_stat, "province_top": monitor.province_top,
                  "click_trend": monitor.recent_hour}[query]()
        assert tuples(counts, "ad_id", "click_count") == [(5, 6), (6, 1)]


def fail(*_):
    raise OSError("lost")


def fail_at(patch, module, step, number):
    """Let a step fail once it has been taken so many times."""
    real, left = getattr(module, step), [number]

    def once(*args):
        if left[0] == 0:
            fail()
        left[0] -= 1
        return real(*args)

    patch.setattr(module, step, once)


@pytest.fixture(params=["the jobs' session", "Spark's defaults"])
def any_session(request, spark, root):
    """The session of the jobs, and one that runs batches without data and has another state store."""
    if request.param == "the jobs' session":
        yield spark
        return
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    other.conf.set("spark.sql.shuffle.partitions", "1")
    other.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    other.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield other


def test_batches_without_a_click_to_count(any_session, root):
    spark = any_session
    queries = "filter", "user_clicks", "ad_stat", "province_top", "click_trend"
    arrive(spark, root, *[line(1, 5)] * 3)
    run(spark, root, *queries, threshold=2)
    # Only rejects, only clicks of the future, only a listed user.
    for lines in (["no click", ""], [AHEAD, AHEAD],
                  [line(1, 5), line(1, 6)]):
        arrive(spark, root, *lines)
        monitor = run(spark, root, *queries, threshold=2)
        assert tuples(monitor.blacklist()) == [(1,)]
        assert tuples(monitor.user_clicks(), "user_id", "click_count") == [(1, 3)]
        for counts in (monitor.ad_stat(), monitor.province_top(), monitor.click_trend(),
                       monitor.recent_hour()):
            assert tuples(counts, "click_count") == [(3,)]
    arrive(spark, root, line(4, 5, 24 * 60 * 3))
    monitor = run(spark, root, *queries, threshold=2)
    assert tuples(monitor.user_clicks(), "user_id", "click_count") == [(1, 3), (4, 1)]
    assert monitor.rejects().count() == 2 and monitor.out_of_time().count() == 2


def test_a_first_batch_without_a_click(any_session, root):
    spark = any_session
    queries = "filter", "user_clicks", "click_trend"
    arrive(spark, root, "no click")
    monitor = run(spark, root, *queries)
    assert monitor.blacklist().count() == monitor.recent_hour().count() == 0
    arrive(spark, root, line(1, 5))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.recent_hour(), "click_count") == [(1,)]


def test_days_of_a_user_expire_and_the_mark_stays(spark, root):
    """Read from the state itself: open days only, and listed users for good."""
    def state():
        rows = (spark.read.format("statestore").option("stateVarName", "user")
                .load(f"{root}/checkpoints/user_clicks"))
        return sorted((r.key.user_id, len(r.value.days), r.value.listed) for r in rows.collect())

    queries = "filter", "user_clicks"
    arrive(spark, root, *[line(1, 5)] * 3, line(2, 5), line(2, 6))
    run(spark, root, *queries, threshold=2)
    assert state() == [(1, 1, True), (2, 2, False)]
    for day in (1, 2, 3, 4):
        arrive(spark, root, line(3, 5, day * 24 * 60))
        monitor = run(spark, root, *queries, threshold=2)
    # A batch closes days by what came before it. User 2 is forgotten, user 1 is not.
    assert state() == [(1, 0, True), (3, 3, False)]
    assert tuples(monitor.blacklist()) == [(1,)]
    assert tuples(monitor.user_clicks(), "date", "user_id", "click_count")[:3] == [
        ("20240110", 1, 3), ("20240110", 2, 1), ("20240110", 2, 1)]


def test_a_user_is_one_row_and_one_timer(spark, root):
    """However many days and ads: each costs a call to the state store or a row in Python."""
    arrive(spark, root, *[line(1, ad, day * 24 * 60) for day in range(4) for ad in (5, 5, 6)])
    monitor = run(spark, root, "filter", day_late_by="10 days", threshold=1)
    query = monitor.start_user_clicks(CATCH_UP)
    query.awaitTermination()
    first = next(p for p in query.recentProgress if p["numInputRows"])
    assert first["numInputRows"] == 1
    assert first["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] == 1
    assert tuples(monitor.blacklist()) == [(1,)]
    assert tuples(monitor.user_clicks(), "date", "user_id", "ad_id", "click_count") == [
        (f"202401{10 + day}", 1, ad, n) for day in range(4) for ad, n in ((5, 2), (6, 1))]


def test_one_timer_after_the_other_drops_the_days_of_a_user(spark, root):
    """Also where an earlier day comes after a later one."""
    queries = "filter", "user_clicks"
    for user, days in ((1, (2, 3)), (1, (1,)), (2, (4,)), (2, (5,)), (2, (5,))):
        arrive(spark, root, *[line(user, 5, day * 24 * 60) for day in days])
        monitor = run(spark, root, *queries, day_late_by="49 hours")
    state = (spark.read.format("statestore").option("stateVarName", "user")
             .load(f"{root}/checkpoints/user_clicks"))
    assert sorted((r.key.user_id, len(r.value.days)) for r in state.collect()) == [(1, 1), (2, 2)]
    assert tuples(monitor.user_clicks(), "date", "user_id", "click_count") == [
        ("20240111", 1, 1), ("20240112", 1, 1), ("20240113", 1, 1), ("20240114", 2, 1),
        ("20240115", 2, 2)]


def test_the_last_hour_moves_on(spark, root):
    queries = "filter", "click_trend"
    arrive(spark, root, line(1, 5), line(1, 5, 30), line(1, 6, 30))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.recent_hour(), "minute", "ad_id") == [("00", 5), ("30", 5), ("30", 6)]
    arrive(spark, root, line(2, 5, 59), line(2, 5, 30))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.recent_hour(), "minute", "ad_id", "click_count") == [
        ("00", 5, 1), ("30", 5, 2), ("30", 6, 1), ("59", 5, 1)]
    arrive(spark, root, line(2, 5, 60))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.recent_hour(), "hour", "minute", "ad_id") == [
        ("12", "30", 5), ("12", "30", 6), ("12", "59", 5), ("13", "00", 5)]
    arrive(spark, root, line(2, 7, 500))
    monitor = run(spark, root, *queries)
    assert tuples(monitor.recent_hour(), "ad_id") == [(7,)]
    assert monitor.click_trend().count() == 6


def test_what_a_batch_lists_does_not_grow(spark, root):
    """Over batches of a day each: the closed days are a run each, and the inboxes are swept."""
    for day in range(11):
        arrive(spark, root, line(1, 5, day * 24 * 60), line(day, 6, day * 24 * 60), "no click")
        monitor = run(spark, root, "filter", "ad_stat")
        arrive(spark, root, line(1, 5, day * 24 * 60))
    for name in ("clean", "ad_stat"):
        days = [r.day for r in monitor.table(name).manifest().runs]
        assert len(set(days)) == 11 and len(days) <= 11 + 4
    assert len(os.listdir(f"{root}/inbox/ad_stat")) <= ad_monitor.SETTLED + 3
    assert monitor.clean().count() == monitor.ad_stat().agg(F.sum("click_count")).first()[0] == 32


def test_best_ads_grow_batch_by_batch(spark, root):
    batches = [
        [line(1, ad) for ad in (1, 1, 1, 2, 2, 3, 4)],
        # Ad 4 overtakes ad 3, and a province shows up.
        [line(1, 4), line(1, 4), line(1, 4), line(1, 9, province="q")],
        # Only province q changes.
        [line(1, 8, province="q"), line(1, 8, province="q")],
        [line(1, 5)] * 2 + [line(1, 3)] * 9,
    ]
    for batch in batches:
        arrive(spark, root, *batch)
        monitor = run(spark, root, "filter", "ad_stat", "province_top")
        expected = ads.province_top(ads.province_clicks(monitor.ad_stat()))
        assert tuples(monitor.province_top(), *expected.columns) == tuples(expected)
    assert tuples(monitor.province_top(), "province", "ad_id", "click_count") == [
        ("p", 1, 3), ("p", 3, 10), ("p", 4, 4), ("q", 8, 2), ("q", 9, 1)]


def test_streams_agree_with_batches(spark, root, sf_dir):
    lines = star_schema.ad_lines(spark, sf_dir)
    # Four files, one micro-batch each, in whatever order they are read.
    lines.select("value").repartition(4).write.text(f"{root}/lines")
    late = "60 days"
    monitor = AdMonitor(spark, root, day_late_by=late, minute_late_by=late).create_tables()
    source = text_lines(spark, f"{root}/lines", max_files=1)
    queries = monitor.start_all(source, CATCH_UP)
    for query in queries:
        query.awaitTermination()
    for start in (monitor.start_user_clicks, monitor.start_ad_stat, monitor.start_province_top,
                  monitor.start_click_trend):
        start(CATCH_UP).awaitTermination()
    for name in ("clean", "ad_stat", "ad_user_click_count", "ad_click_trend"):
        # Merged in the middle of the stream or not, the tables are the same.
        monitor.table(name).compact(lambda day: True)
    clicks = ads.valid_clicks(lines)
    per_city = ads.city_clicks(clicks)
    for streamed, expected in (
            (monitor.user_clicks(), ads.user_clicks(clicks)),
            (monitor.ad_stat(), per_city),
            (monitor.province_top(), ads.province_top(ads.province_clicks(per_city))),
            (monitor.click_trend(), ads.minute_trend(ads.minute_clicks(clicks))),
            (monitor.recent_hour(), ads.minute_trend(ads.minute_clicks(ads.recent_clicks(clicks))))):
        streamed = streamed.select(*expected.columns)
        assert streamed.exceptAll(expected).count() == expected.exceptAll(streamed).count() == 0
        assert streamed.count() > 0
    assert monitor.blacklist().count() == 0


def test_live_trigger(spark, root):
    monitor = AdMonitor(spark, root).create_tables()
    arrive(spark, root, line(1, 5))
    query = monitor.start_filter(text_lines(spark, f"{root}/lines"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert monitor.clean().agg(F.count("*")).first()[0] == 1


def test_kafka_needs_its_connector(spark):
    try:
        lines = kafka_lines(spark, "localhost:9092", "clicks")
    except AnalysisException as missing:
        assert "kafka" in str(missing).lower()
    else:
        assert lines.isStreaming and lines.columns == ["value"]
