from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickweave import TaskParams
from clickweave.__main__ import main
from clickweave.session import work_folder
from clickweave.sources import star_schema, tables
from tests.tables import tuples

PARAMS = {"startDate": "2024-01-10", "endDate": "2024-01-10", "startAge": 20, "endAge": 50,
          "professionals": "", "cities": "", "sex": "", "keywords": "", "categoryIds": "",
          "targetPageFlow": "1,2,3,4"}


@pytest.fixture(scope="module")
def folders(spark, sf_dir):
    """The tables as the jobs meet them: times as text with one-digit hours, no event id."""
    root = work_folder(spark, "tables")
    actions = star_schema.user_visit_action(spark, sf_dir).drop("event_id")
    (actions.withColumn("action_time", F.date_format("action_time", "yyyy-MM-dd H:mm:ss"))
     .write.partitionBy("date").parquet(f"{root}/actions"))
    star_schema.user_info(spark, sf_dir).write.parquet(f"{root}/users")
    star_schema.product_info(spark, sf_dir).write.parquet(f"{root}/products")
    return root


def job(folders, name, *args, out="out"):
    main([name, "--actions", f"{folders}/actions", *args, "--params", json.dumps(PARAMS),
          "--task-id", "t1", "--out", f"{folders}/{out}"])


def result(spark, folders, name):
    return spark.read.parquet(f"{folders}/out/{name}")


def test_params():
    params = TaskParams.from_json(json.dumps(PARAMS))
    assert params == TaskParams("2024-01-10", "2024-01-10", 20, 50,
                                target_page_flow=(1, 2, 3, 4))
    lists = TaskParams.from_mapping({"cities": "a,b", "categoryIds": "1,2", "startAge": "7"})
    assert (lists.cities, lists.category_ids, lists.start_age) == (("a", "b"), (1, 2), 7)


def test_dates_prune_partitions(spark, folders):
    actions = tables.read_actions(spark, f"{folders}/actions")
    assert dict(actions.dtypes)["action_time"] == "timestamp_ntz"
    one_day = tables.actions_in_range(actions, "2024-01-10", "2024-01-10")
    assert {f.split("date=")[1][:10] for f in one_day.inputFiles()} >= {"2024-01-10"}
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_session_job(spark, folders):
    job(folders, "session", "--users", f"{folders}/users")
    ratio = result(spark, folders, "session_stat_ratio").first()
    sessions = ratio["session_count"]
    assert 0 < sessions < 100
    assert sum(ratio[c] for c in ratio.asDict() if c.startswith("step")) == pytest.approx(1, abs=.03)
    extract = result(spark, folders, "session_extract")
    assert set(extract.columns) == {"taskid", "sessionid", "startTime", "searchKeywords",
                                    "clickCategoryIds"}
    # One day, and fewer sessions than the hundred asked for: all are drawn.
    assert extract.count() == sessions
    detail = result(spark, folders, "session_detail")
    assert detail.select("sessionid").distinct().count() == sessions
    top = result(spark, folders, "top10_category")
    assert top.count() == 10
    best = result(spark, folders, "top10_session")
    assert 0 < best.groupBy("categoryid").count().agg(F.max("count")).first()[0] <= 10
    clicks = {r["categoryid"]: r["clickCount"] for r in top.collect()}
    for category, count in best.groupBy("categoryid").agg(F.sum("clickCount")).collect():
        assert count <= clicks[category]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_sample_size_and_partitions_are_arguments(spark, folders):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    job(folders, "session", "--users", f"{folders}/users", "--sample-size", "24",
        "--shuffle-partitions", before)
    # The parts of the hours are rounded down.
    assert 0 < result(spark, folders, "session_extract").count() <= 24


def test_page_job(spark, folders):
    job(folders, "page")
    text = result(spark, folders, "page_split_convert_rate").first()["convertRate"]
    assert [step.split("=")[0] for step in text.split("|")] == ["1_2", "2_3", "3_4"]


def test_region_job(spark, folders):
    job(folders, "region", "--products", f"{folders}/products")
    rows = result(spark, folders, "area_top3_product")
    assert tuples(rows.groupBy("area").count().select("count").distinct()) == [(3,)]
    assert {"productid", "areaLevel", "cityInfos", "productStatus"} < set(rows.columns)
    assert tuples(rows.select("taskid").distinct()) == [("t1",)]
