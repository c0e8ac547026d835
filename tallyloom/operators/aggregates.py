"""Grouped and global aggregates.

All are built from aggregates with partial results, so every task reduces
its own rows before the shuffle and a key that holds most of the rows sends
one row for each task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import server_time_to_millis
from tallyloom.functions.text import browser_dimension, platform_dimension, split_words

LAUNCH = "e_l"


def exact(value: Column, precision: int = 28, scale: int = 6) -> Column:
    """A double as a decimal, so that a sum does not depend on the order of the rows.

    A value is rounded to ``scale`` places, and one with more than ``precision - scale`` digits before the point (22 unless
    said otherwise) becomes null, or an error in ANSI mode.  A sum of such values has ten digits more.
    """
    return value.cast(f"decimal({precision},{scale})")


def rounded_avg(value: Column, scale: int = 2) -> Column:
    total = F.sum(exact(value))
    return F.round(F.try_divide(total, F.count(value)), scale).cast("double")


def rounded_sum(value: Column, scale: int = 2) -> Column:
    return F.round(F.sum(exact(value)), scale).cast("double")


def words(df: DataFrame, col: str, drop_blank: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each word; ``drop_blank`` trims words and leaves out empty ones."""
    exploded = df.select(*keep, F.explode(split_words(F.col(col))).alias("word"))
    return exploded.filter(F.trim("word") != "") if drop_blank else exploded


def word_count(df: DataFrame, col: str = "value", drop_blank: bool = False) -> DataFrame:
    return words(df, col, drop_blank).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def content_size_stats(df: DataFrame, col: str = "content_size") -> DataFrame:
    """Average, minimum and maximum in one pass."""
    return df.agg(
        F.avg(col).alias("avg_size"), F.min(col).alias("min_size"), F.max(col).alias("max_size")
    )


def _counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def response_code_counts(df: DataFrame, col: str = "response_code", n: int = 20) -> DataFrame:
    return _counts(df, col).orderBy(F.desc("cnt"), F.asc(col)).limit(n)


def frequent_ips(df: DataFrame, col: str = "ip_address", min_count: int = 30, n: int = 20) -> DataFrame:
    """Addresses seen more than ``min_count`` times, the most frequent first."""
    return _counts(df, col).filter(F.col("cnt") > min_count).orderBy(F.desc("cnt"), F.asc(col)).limit(n)


def top_endpoints(df: DataFrame, col: str = "endpoint", n: int = 5) -> DataFrame:
    return _counts(df, col).orderBy(F.desc("cnt"), F.asc(col)).limit(n)


def sum_rounded(df: DataFrame, col: str, scale: int = 2) -> DataFrame:
    return df.agg(rounded_sum(F.col(col), scale).alias("sum_amt"))


def user_order_count(
    df: DataFrame, user: str, amount: str, min_amount: float = 50, min_count: int = 2, n: int = 5
) -> DataFrame:
    """Users by their number of orders above an amount."""
    return (
        _counts(df.filter(F.col(amount) > min_amount), user)
        .filter(F.col("cnt") >= min_count)
        .orderBy(F.desc("cnt"), F.asc(user))
        .limit(n)
    )


def movie_rating_summary(
    df: DataFrame, item: str, rating: str, min_count: int = 100, n: int = 20
) -> DataFrame:
    """Items with more than ``min_count`` ratings, by number and then by average."""
    return (
        df.groupBy(item)
        .agg(F.count(item).alias("cnt"), rounded_avg(F.col(rating)).alias("avg_rating"))
        .filter(F.col("cnt") > min_count)
        .orderBy(F.desc("cnt"), F.desc("avg_rating"), F.asc(item))
        .limit(n)
    )


def dept_avg_salary(df: DataFrame, dept: str, sal: str) -> DataFrame:
    return df.groupBy(dept).agg(rounded_avg(F.col(sal)).alias("avg_sal"))


def user_aggregate(
    df: DataFrame,
    keys: list[str],
    buffer: Mapping[str, Column],
    evaluate: Callable[[Mapping[str, Column]], Column],
    out: str,
) -> DataFrame:
    """An aggregate of one's own: named buffer columns and the result they give.

    The buffer columns are built-in aggregates, which Spark fills in each
    task and merges after the shuffle.  A Python aggregate would need all
    rows of a group in one worker.
    """
    filled = df.groupBy(*keys).agg(*[expr.alias(f"_{name}") for name, expr in buffer.items()])
    return filled.select(*keys, evaluate({name: F.col(f"_{name}") for name in buffer}).alias(out))


def avg_udaf(df: DataFrame, key: str, value: str) -> DataFrame:
    """The average as sum and count; nulls are left out."""
    return user_aggregate(
        df,
        [key],
        {"total": F.sum(value), "count": F.count(value)},
        lambda b: F.try_divide(b["total"], b["count"]),
        "avg_value",
    )


def group_concat_distinct(df: DataFrame, keys: list[str], id: str, name: str, out: str) -> DataFrame:
    """For each group ``id:name:count,…``, sorted by id.

    Counted by (keys, id, name) first; what is gathered for a group is one
    short entry for each distinct id.
    """
    counted = df.groupBy(*keys, id, name).agg(F.count(F.lit(1)).alias("_n"))
    gathered = counted.groupBy(*keys).agg(_entries(id, name).alias(out))
    return gathered.withColumn(out, _entries_text(F.col(out)))


def _entries(id: str, name: str) -> Column:
    return F.collect_list(F.struct(F.col(id).alias("id"), F.col(name).alias("name"), F.col("_n").alias("n")))


def _entries_text(entries: Column) -> Column:
    label = lambda e: F.concat_ws(
        ":", e["id"].cast("string"), F.coalesce(e["name"], F.lit("null")), e["n"].cast("string")
    )
    return F.array_join(F.transform(F.sort_array(entries), label), ",")


def conditional_count(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Rows of each group where the text is not empty; a group of empty texts stays, with 0."""
    return df.groupBy(*keys).agg(F.count(F.when(F.length(col) > 0, F.col(col))).alias("cnt"))


def area_product_entries(df: DataFrame) -> DataFrame:
    """Clicks for each area and product, with the counts of its cities as a list.

    Expects area, click_product_id, city_id and city_name.  One count by city
    serves both results.
    """
    keys = ["area", "click_product_id", "city_id", "city_name"]
    return city_counts_to_areas(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))


def city_counts_to_areas(by_city: DataFrame) -> DataFrame:
    """The same from counts ``_n`` for each product and city, a city on one row."""
    cities = _entries("city_id", "city_name").alias("city_infos")
    return by_city.groupBy("area", "click_product_id").agg(F.sum("_n").alias("click_count"), cities)


def entries_as_text(df: DataFrame) -> DataFrame:
    """The city list of ``area_product_entries`` as ``id:name:count,…``."""
    return df.withColumn("city_infos", _entries_text(F.col("city_infos")))


def area_product_clicks(df: DataFrame) -> DataFrame:
    """Clicks for each area and product, with the clicks of its cities as text."""
    return entries_as_text(area_product_entries(df))


def new_user_dimensions(df: DataFrame) -> DataFrame:
    """Launch events with their day of the month, platform and browser.

    Expects en, u_ud, s_time, pl, ver, browser and browser_v.
    """
    millis = server_time_to_millis(F.col("s_time"))
    return df.filter(
        (F.col("en") == LAUNCH) & F.col("u_ud").isNotNull() & F.col("s_time").isNotNull()
    ).select(
        F.dayofmonth(F.timestamp_millis(millis)).alias("day"),
        platform_dimension(F.col("pl"), F.col("ver")).alias("platform_dimension"),
        browser_dimension(F.col("browser"), F.col("browser_v")).alias("browser_dimension"),
    )


def new_users_by_platform(df: DataFrame) -> DataFrame:
    """Launch events by day and platform: events, not distinct users."""
    return (
        new_user_dimensions(df)
        .groupBy("day", "platform_dimension")
        .agg(F.count(F.lit(1)).alias("new_users"))
    )


def new_users_by_platform_browser(df: DataFrame) -> DataFrame:
    return (
        new_user_dimensions(df)
        .groupBy("day", "platform_dimension", "browser_dimension")
        .agg(F.count(F.lit(1)).alias("new_users"))
    )


def new_users_both(df: DataFrame) -> DataFrame:
    """Both counts from one shuffle; ``browser_dimension`` is null in the coarser one.

    The finer count is small, and the coarser one is its sum.
    """
    dims = ["day", "platform_dimension", "browser_dimension"]
    fine = new_users_by_platform_browser(df)
    return fine.groupingSets([dims, dims[:2]], *dims).agg(F.sum("new_users").alias("new_users"))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    return _counts(df, col)
