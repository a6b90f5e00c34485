from __future__ import annotations

import pytest

from clickweave.operators import regions
from clickweave.sources.tables import city_dimension, clicked_products
from tests.tables import action, actions, tuples


@pytest.fixture(scope="module")
def clicks(spark):
    visits = [(1, 7), (1, 7), (2, 7), (0, 7), (1, 8), (2, 9), (9, 8), (77, 7), (1, -1)]
    return clicked_products(actions(spark, *[
        action(i, "a", i, product=p, city_id=c) for i, (c, p) in enumerate(visits)]))


def test_clicks_without_product_or_city_are_dropped(spark, clicks):
    assert clicks.count() == 8
    assert regions.click_cities(clicks, city_dimension(spark)).count() == 7


def test_counts_and_city_lists(spark, clicks):
    found = regions.area_product_clicks(clicks, city_dimension(spark))
    assert tuples(found, "area", "pid", "click_count", "city_infos") == [
        ("东北", 8, 1, "9:哈尔滨"), ("华东", 7, 3, "1:上海,2:南京"), ("华东", 8, 1, "1:上海"),
        ("华东", 9, 1, "2:南京"), ("华北", 7, 1, "0:北京")]


def test_top_products(spark, clicks):
    products = spark.createDataFrame(
        [(7, "bolt", '{"product_status": 0}'), (8, "nut", '{"product_status": 1}')],
        "product_id BIGINT, product_name STRING, extend_info STRING")
    counted = regions.area_product_clicks(clicks, city_dimension(spark))
    info = regions.area_product_info(counted, products)
    assert info.where("pid = 9").count() == 0
    assert tuples(regions.top_products(info, 1), "area", "area_level", "pid", "product_status") \
        == [("东北", "D_Level", 8, "Third Party"), ("华东", "A_Level", 7, "Self"),
            ("华北", "A_Level", 7, "Self")]


def test_ties_go_to_the_lower_product(spark):
    rows = [("x", "1:c", p, "n", "Self", 5) for p in (4, 2, 3, 1)]
    info = spark.createDataFrame(rows, """area STRING, city_infos STRING, pid BIGINT,
        product_name STRING, product_status STRING, click_count BIGINT""")
    assert [p for p, in tuples(regions.top_products(info), "pid")] == [1, 2, 3]
