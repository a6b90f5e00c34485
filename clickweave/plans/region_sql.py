"""The region job as SQL over named intermediate views, for users who keep their queries in SQL.

The statements give the plan of `operators.regions`, with clicks counted per city first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickweave.functions import sql

VIEWS = {
    "city_clicks": """
        SELECT city_id, click_product_id AS pid, count(*) AS clicks
        FROM clicked_products GROUP BY ALL""",
    "area_clicks": """
        WITH named AS (
          SELECT area, pid, clicks, concat_long_string(city_id, city_name, ':') AS city
          FROM city_clicks JOIN city_info USING (city_id))
        SELECT area, pid, sum(clicks) AS click_count,
          listagg(DISTINCT city, ',') WITHIN GROUP (ORDER BY city) AS city_infos
        FROM named GROUP BY ALL""",
    "area_products": """
        SELECT area, city_infos, pid, product_name, click_count,
          CASE get_json_field(extend_info, 'product_status') WHEN '0' THEN 'Self'
            ELSE 'Third Party' END AS product_status
        FROM area_clicks JOIN product_info ON product_id = pid""",
    "area_top3_product": """
        WITH ranked AS (
          SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS position
          FROM area_products)
        SELECT area, area_level(area) AS area_level, pid, city_infos, click_count, product_name,
          product_status
        FROM ranked WHERE position <= 3""",
}


def region_views(clicked_products: DataFrame, products: DataFrame, cities: DataFrame) -> DataFrame:
    """Create the views one after the other; the last one is the result."""
    spark = clicked_products.sparkSession
    sql.register(spark)
    clicked_products.createOrReplaceTempView("clicked_products")
    products.createOrReplaceTempView("product_info")
    cities.createOrReplaceTempView("city_info")
    for name, statement in VIEWS.items():
        spark.sql(statement).createOrReplaceTempView(name)
    return spark.table("area_top3_product")
