"""Result tables of the jobs: their columns and where they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.sources import sinks

# Column names of the result tables, by the names the operators use.
RESULT_COLUMNS = {
    "session_extract": {
        "session_id": "sessionid", "start_time": "startTime",
        "search_keywords": "searchKeywords", "click_category_ids": "clickCategoryIds",
    },
    "session_detail": {
        "user_id": "userid", "session_id": "sessionid", "page_id": "pageid",
        "action_time": "actionTime", "search_keyword": "searchKeyword",
        "click_category_id": "clickCategoryId", "click_product_id": "clickProductId",
        "order_category_ids": "orderCategoryIds", "order_product_ids": "orderProductIds",
        "pay_category_ids": "payCategoryIds", "pay_product_ids": "payProductIds",
    },
    "top10_category": {
        "category_id": "categoryid", "click_count": "clickCount",
        "order_count": "orderCount", "pay_count": "payCount",
    },
    "top10_session": {
        "category_id": "categoryid", "session_id": "sessionid", "click_count": "clickCount",
    },
    "page_split_convert_rate": {"convert_rate": "convertRate"},
    "area_top3_product": {
        "area": "area", "area_level": "areaLevel", "pid": "productid",
        "city_infos": "cityInfos", "click_count": "clickCount",
        "product_name": "productName", "product_status": "productStatus",
    },
}

Writer = Callable[[str, DataFrame], None]


def result_table(name: str, rows: DataFrame) -> DataFrame:
    """The rows under the column names of a result table."""
    names = RESULT_COLUMNS.get(name)
    return rows if names is None else rows.select(*[F.col(k).alias(v) for k, v in names.items()])


def to_folder(root: str, task_id: str) -> Writer:
    """Append each result table below `root/<table>/taskid=<task>`."""
    return lambda name, rows: sinks.append_result(result_table(name, rows), f"{root}/{name}",
                                                  task_id)


def to_jdbc(url: str, properties: dict[str, str], task_id: str) -> Writer:
    """Append each result table to the table of its name in a database."""
    return lambda name, rows: sinks.append_jdbc(result_table(name, rows), url, name, task_id,
                                                properties)
