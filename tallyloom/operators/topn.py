"""Top-N, within groups and overall.

A filter directly on ``row_number`` lets Spark keep only the first n rows
of each key in every task before the shuffle, so a hot key sends n rows for
each task and not its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import area_product_entries, entries_as_text


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group with their row number."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def group_topn_values(df: DataFrame, key: str, value: str, n: int = 3) -> DataFrame:
    """The ``n`` largest values of every key as a list, largest first."""
    kept = first_n(df.select(key, value), [key], [F.desc(value)], n)
    return kept.groupBy(key).agg(
        F.sort_array(F.collect_list(value), asc=False).alias("top_values")
    )


def group_topn_salted(df: DataFrame, key: str, value: str, n: int = 3, salts: int = 2) -> DataFrame:
    """The same in two steps: every key is cut into ``salts`` parts first.

    The salt is a hash of the row and not a random number, so a task that is
    run again puts its rows where they were before.
    """
    salted = df.select(key, value).withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(key), F.col(value)), F.lit(salts))
    )
    local = first_n(salted, [key, "_salt"], [F.desc(value)], n)
    return group_topn_values(local, key, value, n)


def sort_all_desc(df: DataFrame, col: str, tie: str) -> DataFrame:
    """Total order, largest first: a range shuffle, not one task."""
    return df.orderBy(F.desc(col), F.desc(tie))


def bottom_k(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The ``n`` smallest rows."""
    return df.orderBy(*[F.asc(c) for c in order]).limit(n)


def top_k(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The ``n`` largest rows."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def top_k_custom_order(df: DataFrame, expr: Column, tie: str, n: int = 3) -> DataFrame:
    """The ``n`` rows with the largest value of an expression; ``tie`` settles equal ones."""
    return df.orderBy(expr.desc(), F.asc(tie)).limit(n)


def area_top_products(clicks_with_area: DataFrame, n: int = 10) -> DataFrame:
    """The most clicked products of every area."""
    return top_of_areas(area_product_entries(clicks_with_area), n)


def top_of_areas(counted: DataFrame, n: int = 10) -> DataFrame:
    """The same from counts; the city lists become text after the ranking, for the products in it."""
    order = [F.desc("click_count"), F.asc("click_product_id")]
    return entries_as_text(first_n(counted, ["area"], order, n))


def province_top5_ads(state: DataFrame, n: int = 5) -> DataFrame:
    """The ads with most clicks for each date and province, ranked from 0.

    ``state`` has date, province, ad_id and click_count, by city or not.
    """
    summed = state.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))
    ranked = first_n(summed, ["date", "province"], [F.desc("click_count"), F.asc("ad_id")], n)
    return ranked.withColumn("rank", F.col("rank") - 1)


def province_top5_packed(state: DataFrame, n: int = 5) -> DataFrame:
    """The same ranking as one text for each ``date:province``: ``ad:count,ad:count,…``."""
    entry = F.struct("rank", F.concat_ws(":", "ad_id", "click_count").alias("label"))
    ordered = F.sort_array(F.collect_list(entry))
    return (
        province_top5_ads(state, n)
        .groupBy("date", "province")
        .agg(F.array_join(F.transform(ordered, lambda e: e["label"]), ",").alias("value"))
        .select(F.concat_ws(":", "date", "province").alias("key"), "value")
    )


def province_top5_ads_sql(state: DataFrame, n: int = 5) -> DataFrame:
    """The ranking by province alone: rows of different dates compete."""
    order = [F.desc("click_count"), F.asc("date"), F.asc("ad_id")]
    return first_n(state, ["province"], order, n).select("date", "province", "ad_id", "click_count")
