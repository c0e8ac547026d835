"""Joins of clicks with dimensions, and exclusion lists.

No side is broadcast unconditionally.  Catalyst broadcasts a side whose
size it knows to be below ``spark.sql.autoBroadcastJoinThreshold``, AQE
does it for a side it has measured, and AQE splits skewed partitions of the
remaining sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.membership import membership_anti_join

BROADCAST_ROWS = 1_000_000


def clicks_left_join_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with city and area; a click of an unknown city stays, without an area."""
    return clicks.join(cities, "city_id", "left")


def clicks_join_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks of known cities with city and area."""
    return clicks.join(cities, "city_id")


def top10_join_product(top: DataFrame, products: DataFrame) -> DataFrame:
    """Product columns for a ranking; products without an entry are left out."""
    return top.join(products, F.col("click_product_id") == F.col("product_id")).drop("click_product_id")


def top10_fanout_join(visits: DataFrame, top: DataFrame) -> DataFrame:
    """Every visit of a ranked product, once for each area that ranks it.

    The join is on the product alone, so the area of the visit and the area
    of the ranking may differ; the result has that of the visit.
    """
    ranked = top.select(
        "product_id",
        F.col("click_count").alias("area_click_count"),
        *[c for c in ("product_name", "extend_info") if c in top.columns],
    )
    return visits.join(ranked, F.col("click_product_id") == F.col("product_id")).drop("click_product_id")


def blacklist_left_outer_filter(df: DataFrame, black: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not on the list."""
    return df.join(black.select(key), key, "left_anti")


def blacklist_broadcast_filter(
    df: DataFrame, black: DataFrame, key: str, max_rows: int = BROADCAST_ROWS, bits: DataFrame | None = None
) -> DataFrame:
    """The same with the list sent to every executor, if it is short enough.

    The list is counted first, with one number from each task; a longer one
    goes through the ordinary anti join, or, with the ``membership_bits`` of
    the list, through a filter that spares most rows the shuffle.  ``black``
    should be a stored list, because it is read for the count and for the join.
    """
    listed = black.select(key)
    short = listed.count() <= max_rows
    if not short and bits is not None:
        return membership_anti_join(df, listed, key, bits)
    return df.join(F.broadcast(listed) if short else listed, key, "left_anti")


def whitelist_exclusion(df: DataFrame, white: DataFrame, key: str) -> DataFrame:
    """Candidates that are not on the white list."""
    return df.join(white.select(key), key, "left_anti")


def prediction_actual_join(pred: DataFrame, actual: DataFrame, user: str, item: str) -> DataFrame:
    """Predictions next to the ratings of the same user and item."""
    return pred.join(actual, [user, item])
