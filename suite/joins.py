"""Joins, exclusion lists, routing and the area reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.aggregates import AREA_CLICKS, CLICKS
from suite.registry import query
from suite.tables import (
    AD_CLICKS,
    AREA_LEVELS,
    CITIES,
    ORDERS,
    PRODUCTS,
    RATINGS,
    VISITS,
    ad_clicks,
    cities,
    orders,
    products,
    ratings,
    visits,
    with_ctes,
)
from tallyloom.operators import joins
from tallyloom.operators.aggregates import conditional_count
from tallyloom.operators.routing import route_by_type, train_test_split
from tallyloom.operators.topn import first_n
from tallyloom.plans import area_top_products as plan
from tallyloom.shared_folder import staged

_LEVEL = """CASE area WHEN 'AFRICA' THEN 'A' WHEN 'AMERICA' THEN 'B' WHEN 'ASIA' THEN 'C'
 WHEN 'EUROPE' THEN 'D' ELSE 'E' END"""
_TYPE = "json_extract_string(extend_info, '$.product_type') = '0'"


@query(
    "area_top10_products",
    with_ctes(VISITS, CITIES, PRODUCTS, CLICKS, AREA_CLICKS)
    + f"""SELECT area, {_LEVEL} AS area_level, product_id, city_infos, click_count, product_name,
         CASE WHEN {_TYPE} THEN '自营商品' ELSE '第三方商品' END AS product_type
         FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, click_product_id) AS r
               FROM area_clicks) JOIN products ON click_product_id = product_id WHERE r <= 10""",
)
def _area_top10_products(spark, sf_dir):
    return plan.area_top10_products(
        visits(spark, sf_dir), cities(spark, sf_dir), products(spark, sf_dir), levels=AREA_LEVELS
    )


_COUNTED = """
counted AS (
  SELECT area, click_product_id,
         count(CASE WHEN length(click_product_id) > 0 THEN 1 END) AS click_count
  FROM visits v JOIN cities c ON v.city_id = c.city_id GROUP BY area, click_product_id),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, click_product_id) AS rank
                 FROM counted) WHERE rank <= 10)"""


@query(
    "area_top10_visits",
    with_ctes(VISITS, CITIES, PRODUCTS, _COUNTED)
    + f"""SELECT c.area, {_LEVEL.replace('CASE area', 'CASE c.area')} AS area_level, click_count,
         c.city_id || ':' || city_name AS city_infos, product_id, product_name,
         CASE WHEN {_TYPE} THEN '自营' ELSE '第三方' END AS product_type
         FROM visits v JOIN cities c ON v.city_id = c.city_id
         JOIN top ON top.click_product_id = v.click_product_id
         JOIN products ON product_id = v.click_product_id""",
)
def _area_top10_visits(spark, sf_dir):
    return plan.area_top10_visits(
        visits(spark, sf_dir), cities(spark, sf_dir), products(spark, sf_dir), levels=AREA_LEVELS
    )


@query("clicks_left_join_city", with_ctes(VISITS, CITIES, CLICKS) + "SELECT city_id, click_product_id, city_name, area FROM clicks")
def _clicks_left_join_city(spark, sf_dir):
    clicks = plan.product_clicks(visits(spark, sf_dir))
    return joins.clicks_left_join_city(clicks, cities(spark, sf_dir))


@query(
    "clicks_join_city",
    with_ctes(VISITS, CITIES)
    + "SELECT v.city_id, click_product_id, city_name, area FROM visits v JOIN cities c ON v.city_id = c.city_id",
)
def _clicks_join_city(spark, sf_dir):
    clicks = visits(spark, sf_dir).select("click_product_id", "city_id")
    return joins.clicks_join_city(clicks, cities(spark, sf_dir))


def _top(spark, sf_dir):
    located = joins.clicks_join_city(visits(spark, sf_dir), cities(spark, sf_dir))
    counted = conditional_count(located, ["area", "click_product_id"], "click_product_id")
    order = [F.desc("click_count"), F.asc("click_product_id")]
    return first_n(counted.withColumnRenamed("cnt", "click_count"), ["area"], order, 10)


@query(
    "top10_join_product",
    with_ctes(VISITS, CITIES, PRODUCTS, _COUNTED)
    + """SELECT area, click_count, CAST(rank AS INTEGER) AS rank, product_id, product_name, extend_info
         FROM top JOIN products ON click_product_id = product_id""",
)
def _top10_join_product(spark, sf_dir):
    return joins.top10_join_product(_top(spark, sf_dir), products(spark, sf_dir))


@query(
    "top10_fanout_join",
    with_ctes(VISITS, CITIES, PRODUCTS, _COUNTED)
    + """SELECT date_part, v.city_id, product_id, click_count AS area_click_count, product_name
         FROM visits v JOIN top ON top.click_product_id = v.click_product_id
         JOIN products ON product_id = v.click_product_id""",
)
def _top10_fanout_join(spark, sf_dir):
    top = staged(joins.top10_join_product(_top(spark, sf_dir), products(spark, sf_dir)), "top")
    return joins.top10_fanout_join(visits(spark, sf_dir), top).drop("extend_info")


BLACK = """
black AS (SELECT user_id FROM ad_clicks GROUP BY user_id HAVING count(*) > 70)"""
_ALLOWED = with_ctes(AD_CLICKS, BLACK) + "SELECT * FROM ad_clicks WHERE user_id NOT IN (SELECT user_id FROM black)"


def black_users(spark, sf_dir):
    counts = ad_clicks(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.filter(F.col("cnt") > 70).select("user_id")


@query("blacklist_left_outer_filter", _ALLOWED)
def _blacklist_left_outer_filter(spark, sf_dir):
    return joins.blacklist_left_outer_filter(ad_clicks(spark, sf_dir), black_users(spark, sf_dir), "user_id")


@query("blacklist_broadcast_filter", _ALLOWED)
def _blacklist_broadcast_filter(spark, sf_dir):
    black = staged(black_users(spark, sf_dir), "blacklist")
    return joins.blacklist_broadcast_filter(ad_clicks(spark, sf_dir), black, "user_id")


@query(
    "whitelist_exclusion",
    with_ctes(AD_CLICKS, BLACK)
    + """SELECT user_id FROM black WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""",
)
def _whitelist_exclusion(spark, sf_dir):
    """The white list is made of the customers with most money."""
    return joins.whitelist_exclusion(black_users(spark, sf_dir), white_users(spark, sf_dir), "user_id")


def white_users(spark, sf_dir):
    from suite.tables import table

    rich = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000)
    return rich.select(F.col("c_custkey").alias("user_id"))


@query(
    "prediction_actual_join",
    with_ctes(RATINGS)
    + """SELECT r.user_id, r.item_id, prediction, rating FROM ratings r JOIN
         (SELECT user_id, item_id, max(rating) AS prediction FROM ratings GROUP BY ALL) p
         ON r.user_id = p.user_id AND r.item_id = p.item_id""",
)
def _prediction_actual_join(spark, sf_dir):
    """The best rating of a pair stands for its prediction."""
    actual = ratings(spark, sf_dir)
    pred = actual.groupBy("user_id", "item_id").agg(F.max("rating").alias("prediction"))
    return joins.prediction_actual_join(pred, actual, "user_id", "item_id")


ROUTED = """
routed AS (
  SELECT *, CASE order_type WHEN 'alipay' THEN 'htb_alipay' WHEN 'weixin' THEN 'htb_weixin'
       WHEN 'card' THEN 'htb_card' ELSE 'htb_other' END AS target FROM order_rows)"""


@query("route_by_type", with_ctes(ORDERS, ROUTED) + "SELECT order_id, order_type, target FROM routed")
def _route_by_type(spark, sf_dir):
    from tallyloom.operators.routing import write_routed
    from tallyloom.shared_folder import new_path

    path = new_path(spark, "routed")
    write_routed(route_by_type(orders(spark, sf_dir).select("order_id", "order_type"), "order_type"), path)
    return spark.read.parquet(path)


@query("train_test_split", "SELECT doc_id, 1 AS parts, true AS fair FROM documents")
def _train_test_split(spark, sf_dir):
    """Every row is in one part, and the shares are within five standard deviations of those asked for."""
    from suite.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id")
    train, test = train_test_split(docs)
    n, in_train = docs.count(), train.count()
    fair = abs(in_train - 0.8 * n) <= 5 * (0.16 * n) ** 0.5
    parts = train.union(test).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("parts"))
    return parts.withColumn("fair", F.lit(fair))
