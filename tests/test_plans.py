"""The plans Spark makes of the queries: what reaches the scan, what is shuffled, what is not."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickweave.operators import ads, sessions

BATCH = [name for name in entry.queries() if not name.startswith(("stream_", "sink_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def planned(spark, sf_dir):
    return lambda name: plan(entry.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(planned, name):
    found = planned(name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython",
                     "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in found


def test_scans_read_few_columns_and_take_the_dates(planned):
    found = planned("session_ratios")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" \
        in found
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-05" in found
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in planned("ad_recent_hour")


@pytest.mark.parametrize("name, limit", [
    ("regional_top3", 3), ("top10_sessions", 10), ("ad_province_top3", 3), ("session_sample", 840),
])
def test_ranks_are_cut_before_the_shuffle(planned, name, limit):
    assert re.search(rf"WindowGroupLimit .*row_number\(\), {limit}, Partial", planned(name))


def test_top_categories_are_not_sorted_in_full(planned):
    assert "TakeOrderedAndProject" in planned("top10_categories")


def test_ratios_shuffle_the_log_once(planned):
    # By session, and the single row of counts.
    exchanges = re.findall(r"Exchange (hashpartitioning|SinglePartition)", planned("session_ratios"))
    assert exchanges == ["SinglePartition", "hashpartitioning"]


def test_city_dimension_is_broadcast_unasked(planned):
    found = planned("area_product_clicks")
    assert "BroadcastHashJoin [city_id" in found
    assert "partial_count" in found


@pytest.fixture
def eager_skew_split(spark):
    """Make AQE split at test sizes, and keep small sides from being broadcast."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_a_hot_session_is_split(spark, eager_skew_split):
    log = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("s"), F.col("id") % 5000)).alias("session_id"),
        (F.col("id") % 1000).alias("page_id"))
    ids = log.groupBy("session_id").agg(F.count("*").alias("n"))
    kept = sessions.filtered_actions(log, ids)
    assert "skew=true" in final_plan(kept.groupBy("page_id").count())
    assert kept.count() == 200_000


def test_a_hot_user_is_split(spark, eager_skew_split):
    clicks = spark.range(0, 200_000, 1, 8).select(
        (F.col("id") % 50).cast("string").alias("city"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("user_id"))
    counts = clicks.where("user_id BETWEEN 1 AND 99").groupBy("user_id") \
        .agg(F.count("*").alias("click_count"))
    listed = ads.blacklisted_users(counts, 1)
    kept = ads.without_users(clicks, listed)
    assert "skew=true" in final_plan(kept.groupBy("city").count())
    assert kept.count() == clicks.where("user_id NOT BETWEEN 1 AND 99").count()
