"""Clickstream views of the given star-schema tables.

`events`, `customer` and `part` stand in for the action log, the users and the products. One
user-day is a session; action times are respread inside one hour so that all lengths occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stated so that opening a table reads no file footers.
SCHEMAS = {
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
        c_mktsegment STRING""",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
}

# Spread in seconds of a session's actions, chosen by user.
SPREADS = (4, 10, 31, 61, 181, 601, 1801, 3540)

# User ids start three above the customer keys, so the sessions of users 0 to 2 have no user row.
USER_OFFSET = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, start_date: str | None = None,
            end_date: str | None = None) -> DataFrame:
    """Events of the given days; the bounds are on `ts` itself so that they reach the scan."""
    events = table(spark, sf_dir, "events")
    if start_date is not None:
        events = events.where(F.col("ts") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date is not None:
        after = F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp_ntz")
        events = events.where(F.col("ts") < after)
    return events.selectExpr("*", "CAST(ts AS DATE) AS day",
                             "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")


def user_visit_action(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                      end_date: str | None = None) -> DataFrame:
    """Views become searches, purchases orders, sign-ups payments; errors only page visits."""
    spread = f"array({', '.join(f'{s}L' for s in SPREADS)})" \
        f"[CAST(user_id % {len(SPREADS)} AS INT)]"
    return _events(spark, sf_dir, start_date, end_date).selectExpr(
        "event_id",
        "CAST(day AS STRING) AS date",
        "user_id",
        "concat_ws('_', user_id, day) AS session_id",
        "k % 10 AS page_id",
        f"""timestampadd(SECOND, CAST((user_id % 24) * 3600 + (event_id * 37 + k) % {spread}
            AS INT), CAST(day AS TIMESTAMP_NTZ)) AS action_time""",
        "CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k ELSE -1L END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN event_id * 7 % 100 ELSE -1L END AS click_product_id",
        """CASE WHEN event_type = 'purchase' THEN
             CASE WHEN event_id % 2 = 0 THEN concat_ws(',', k, (k * 3 + 1) % 100)
               ELSE CAST(k AS STRING) END END AS order_category_ids""",
        "CASE WHEN event_type = 'purchase' THEN CAST(event_id * 7 % 100 AS STRING) END"
        " AS order_product_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS pay_category_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(event_id * 7 % 100 AS STRING) END"
        " AS pay_product_ids",
        "event_id % 10 AS city_id")


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        f"c_custkey + {USER_OFFSET} AS user_id",
        "concat('user', c_custkey) AS username",
        "c_name AS name",
        "CAST(c_custkey % 60 AS INT) AS age",
        "concat('professional', c_custkey * 7 % 100) AS professional",
        "concat('city', c_nationkey) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex")


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name",
        """concat('{"product_status": ', p_size % 2, '}') AS extend_info""")


def _ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an ad click: ten provinces of two cities, twenty ads."""
    return _events(spark, sf_dir).selectExpr(
        "event_id", "ts", "event_type", "CAST(user_id % 10 AS STRING) AS province",
        "CAST(user_id % 20 AS STRING) AS city", "user_id", "k % 20 AS ad_id")


def ad_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ad_events(spark, sf_dir).drop("event_type")


def ad_lines(spark: SparkSession, sf_dir: str, broken_errors: bool = False) -> DataFrame:
    """The clicks as log lines, with day and id beside them; `broken_errors` cuts errors short."""
    ad = "CASE WHEN event_type <> 'error' THEN ad_id END" if broken_errors else "ad_id"
    # The wall-clock time is read as UTC whatever the session's zone is.
    since = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
    return _ad_events(spark, sf_dir).selectExpr(
        "event_id", "CAST(ts AS DATE) AS logged_on",
        f"concat_ws(' ', {since}, province, city, user_id, {ad}) AS value")
