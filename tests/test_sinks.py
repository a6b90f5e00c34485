from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from clickweave.session import work_folder
from clickweave.sources import sinks
from tests.tables import tuples

SCHEMA = "date STRING, ad_id BIGINT, click_count BIGINT"
KEYS = ["date", "ad_id"]


@pytest.fixture
def path(spark):
    return work_folder(spark, "sink")


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_append_keeps_other_tasks_and_repeats_safely(spark, path):
    sinks.append_result(rows(spark, ("d", 1, 1)), path, "a")
    sinks.append_result(rows(spark, ("d", 2, 2)), path, "b")
    sinks.append_result(rows(spark, ("d", 1, 1)), path, "a")
    assert tuples(spark.read.parquet(path), "taskid", "ad_id") == [("a", 1), ("b", 2)]


def test_latest_and_sum_over_batches(spark, path):
    sinks.create_batches(spark, path, SCHEMA, ["date"])
    sinks.create_batches(spark, path, SCHEMA, ["date"])
    assert sinks.read_batches(spark, path, SCHEMA).count() == 0
    sinks.write_batch(rows(spark, ("d", 1, 1), ("d", 2, 5)), path, 0, ["date"])
    for _ in range(2):
        sinks.write_batch(rows(spark, ("d", 1, 4), ("e", 1, 2)), path, 1, ["date"])
    batches = sinks.read_batches(spark, path, SCHEMA)
    assert tuples(sinks.latest(batches, KEYS)) == [("d", 1, 4), ("d", 2, 5), ("e", 1, 2)]
    assert tuples(sinks.summed(batches, KEYS)) == [("d", 1, 5), ("d", 2, 5), ("e", 1, 2)]


@pytest.mark.parametrize("adding", [False, True])
def test_compacted_table_takes_later_batches(spark, path, adding):
    sinks.create_batches(spark, path, SCHEMA, ["date"])
    for batch_id, count in enumerate((1, 4, 9)):
        sinks.write_batch(rows(spark, ("d", 1, count)), path, batch_id, ["date"])
    merge = sinks.summed if adding else sinks.latest
    before = sinks.read_batches(spark, path, SCHEMA)
    sinks.compact(before, f"{path}-new", KEYS, 1, adding=adding, partition_by=["date"])
    sinks.write_batch(rows(spark, ("d", 1, 9)), f"{path}-new", 2, ["date"])
    after = sinks.read_batches(spark, f"{path}-new", SCHEMA)
    assert after.count() == 2
    assert tuples(merge(after, KEYS)) == tuples(merge(before, KEYS))


def test_groups_are_replaced_whole(spark, path):
    sinks.replace_groups(rows(spark, ("d", 1, 1), ("d", 2, 1), ("e", 1, 1)), path, ["date"])
    sinks.replace_groups(rows(spark, ("d", 3, 7)), path, ["date"])
    found = spark.read.schema(SCHEMA).parquet(path)
    assert tuples(found, "date", "ad_id", "click_count") == [("d", 3, 7), ("e", 1, 1)]


def test_saved_table_is_dropped_first(spark):
    sinks.replace_table(rows(spark, ("d", 1, 1)), "saved_clicks")
    sinks.replace_table(rows(spark, ("d", 2, 2)).drop("date"), "saved_clicks")
    assert tuples(spark.table("saved_clicks")) == [(2, 2)]


def test_jdbc_writes_are_few_and_carry_the_task(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None,
                        properties=None: calls.append((self._df, url, table, properties)))
    result = rows(spark, ("d", 1, 1)).repartition(50)
    sinks.append_jdbc(result, "jdbc:x", "t", "task", {"user": "u"}, connections=3)
    (written, *target), = calls
    assert target == ["jdbc:x", "t", {"user": "u"}]
    assert written.columns == ["taskid", "date", "ad_id", "click_count"]
    assert written.select(F.spark_partition_id()).distinct().count() <= 3
    assert written.rdd.getNumPartitions() == 3


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    named = work_folder(spark, "x")
    assert named.startswith(spark.conf.get("spark.checkpoint.dir"))

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        work_folder(Session(), "x")
    Context.master = "local[2]"
    assert "/x-" in work_folder(Session(), "x")


def test_a_task_that_becomes_empty(spark, tmp_path):
    path = str(tmp_path / "emptied")
    rows = spark.createDataFrame([(1,), (2,)], "n INT")
    sinks.append_result(rows.limit(0), path, "a:b/c")
    assert spark.read.parquet(path).columns == ["n", "taskid"]
    sinks.append_result(rows, path, "other")
    for now in (rows, rows.limit(0), rows):
        sinks.append_result(now, path, "a:b/c")
        found = spark.read.parquet(path).where("taskid = 'a:b/c'").select("n")
        assert sorted(r.n for r in found.collect()) == sorted(r.n for r in now.collect())
    assert spark.read.parquet(path).where("taskid = 'other'").count() == 2
