"""The action log and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.dates import parse_time

NO_CLICK = -1

ACTION_SCHEMA = """
    date STRING, user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING,
    search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT,
    order_category_ids STRING, order_product_ids STRING,
    pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT
"""
USER_SCHEMA = """
    user_id BIGINT, username STRING, name STRING, age INT,
    professional STRING, city STRING, sex STRING
"""
PRODUCT_SCHEMA = "product_id BIGINT, product_name STRING, extend_info STRING"

# The city dimension, city_id, city_name, area.
CITIES = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A parquet folder if the name is a path, else a table of the catalog."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_actions(spark: SparkSession, name: str) -> DataFrame:
    """The action log with `action_time` as a time."""
    actions = read_table(spark, name)
    if dict(actions.dtypes)["action_time"] == "string":
        actions = actions.withColumn("action_time", parse_time(F.col("action_time")))
    return actions


def actions_in_range(actions: DataFrame, start_date: str | None,
                     end_date: str | None) -> DataFrame:
    """Actions of the given days, both ends included; `date` prunes partitions."""
    if start_date is not None:
        actions = actions.where(F.col("date") >= start_date)
    if end_date is not None:
        actions = actions.where(F.col("date") <= end_date)
    return actions


def clicked_products(actions: DataFrame) -> DataFrame:
    """City and product of every product click."""
    return (actions.where(F.col("click_product_id") != NO_CLICK)
            .select("city_id", "click_product_id"))


def city_dimension(spark: SparkSession) -> DataFrame:
    """The ten cities as a literal relation: of known size, so Catalyst broadcasts it itself."""
    rows = ", ".join(f"({i}L, '{city}', '{area}')" for i, city, area in CITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS city(city_id, city_name, area)")
