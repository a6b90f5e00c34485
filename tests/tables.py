"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime, timedelta

ACTION_SCHEMA = """event_id BIGINT, date STRING, user_id BIGINT, session_id STRING,
    page_id BIGINT, action_time TIMESTAMP_NTZ, search_keyword STRING, click_category_id BIGINT,
    click_product_id BIGINT, order_category_ids STRING, order_product_ids STRING,
    pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT"""
USER_SCHEMA = """user_id BIGINT, username STRING, name STRING, age INT, professional STRING,
    city STRING, sex STRING"""
CLICK_SCHEMA = "ts TIMESTAMP, province STRING, city STRING, user_id BIGINT, ad_id BIGINT"

DAY = datetime(2024, 1, 10)


def action(event_id, session_id, second=0, *, user_id=1, page_id=1, keyword=None, click=-1,
           product=-1, orders=None, pays=None, city_id=0, day=DAY):
    time = day + timedelta(seconds=second)
    return (event_id, time.strftime("%Y-%m-%d"), user_id, session_id, page_id, time, keyword, click,
            product, orders, None, pays, None, city_id)


def actions(spark, *rows):
    return spark.createDataFrame(list(rows), ACTION_SCHEMA)


def user(user_id, age=30, professional="p1", city="c1", sex="male"):
    return (user_id, f"user{user_id}", f"name{user_id}", age, professional, city, sex)


def users(spark, *rows):
    return spark.createDataFrame(list(rows), USER_SCHEMA)


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
