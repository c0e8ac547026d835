"""The most clicked products of every area, with product and area labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import (
    AREA_LEVELS,
    area_level,
    concat_int_string,
    is_not_empty,
    product_type_label,
)
from tallyloom.operators.aggregates import city_counts_to_areas, conditional_count
from tallyloom.operators.joins import (
    clicks_join_city,
    clicks_left_join_city,
    top10_fanout_join,
    top10_join_product,
)
from tallyloom.operators.parsing import optional_date_range
from tallyloom.operators.topn import first_n, top_of_areas
from tallyloom.shared_folder import staged


def product_clicks(
    visits: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Visits that clicked a product, within the dates of the task, down to two columns."""
    clicks = visits.filter(is_not_empty(F.col("click_product_id")))
    if start or end:
        clicks = optional_date_range(clicks, "date_part", start, end)
    return clicks.select("click_product_id", "city_id")


def area_top10_products(
    visits: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = 10,
    start: str | None = None,
    end: str | None = None,
    levels: Mapping[str, str] = AREA_LEVELS,
    keep_unknown_cities: bool = True,
) -> DataFrame:
    """Filter, count, join the city, rank, join the product and label, in one plan.

    Clicks are counted by product and city before the city is joined: the
    join gets counts instead of clicks.  ``cities`` has one row for a city.
    """
    by_city = (
        product_clicks(visits, start, end)
        .groupBy("click_product_id", "city_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    join = clicks_left_join_city if keep_unknown_cities else clicks_join_city
    top = top_of_areas(city_counts_to_areas(join(by_city, cities)), n)
    return top10_join_product(top, products).select(
        "area",
        area_level(F.col("area"), levels).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        product_type_label(F.col("extend_info")).alias("product_type"),
    )


def area_top10_visits(
    visits: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = 10,
    levels: Mapping[str, str] = AREA_LEVELS,
    own: str = "自营",
    third_party: str = "第三方",
) -> DataFrame:
    """The other form of the report: one row for every visit of a ranked product.

    The ranking is at most ``n`` rows for each area.  It is staged, so that
    its size is known before the visits are joined to it: they then need no shuffle.
    """
    located = clicks_join_city(visits, cities)
    counted = conditional_count(located, ["area", "click_product_id"], "click_product_id")
    order = [F.desc("click_count"), F.asc("click_product_id")]
    top = first_n(counted.withColumnRenamed("cnt", "click_count"), ["area"], order, n)
    ranked = staged(top10_join_product(top, products), "area-top")
    return top10_fanout_join(located, ranked).select(
        "area",
        area_level(F.col("area"), levels).alias("area_level"),
        F.col("area_click_count").alias("click_count"),
        concat_int_string(F.col("city_id"), F.col("city_name")).alias("city_infos"),
        "product_id",
        "product_name",
        product_type_label(F.col("extend_info"), own, third_party).alias("product_type"),
    )
