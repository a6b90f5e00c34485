"""Most clicked products of each area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.labels import area_level, product_status
from clickweave.functions.text import concat_long_string, group_concat_distinct


def click_cities(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Product clicks with city name and area; clicks from unknown cities are dropped."""
    return (clicks.join(cities, "city_id")
            .select("city_id", "city_name", "area", F.col("click_product_id").alias("pid")))


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and the list of cities per (area, product).

    Clicks are counted per (city, product) before the join, so the log is reduced on the map side
    and the city lists are built from one row per city.
    """
    per_city = (clicks.groupBy("city_id", F.col("click_product_id").alias("pid"))
                .agg(F.count("*").alias("clicks")))
    city = concat_long_string(F.col("city_id"), F.col("city_name"), ":")
    return (per_city.join(cities, "city_id").groupBy("area", "pid")
            .agg(F.sum("clicks").alias("click_count"),
                 group_concat_distinct(city).alias("city_infos")))


def area_product_info(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Adds product name and status; unknown products are dropped."""
    known = products.select(F.col("product_id").alias("pid"), "product_name",
                            product_status(F.col("extend_info")).alias("product_status"))
    return (area_clicks.join(known, "pid")
            .select("area", "city_infos", "pid", "product_name", "product_status", "click_count"))


def top_products(area_products: DataFrame, size: int = 3) -> DataFrame:
    """The most clicked products of each area, ties by product id, with the area's level."""
    order = Window.partitionBy("area").orderBy(F.desc("click_count"), "pid")
    return (area_products.withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= size)
            .select("area", area_level(F.col("area")).alias("area_level"), "pid", "city_infos",
                    "click_count", "product_name", "product_status"))
