"""Aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.tables import (
    ACCESS_LINES,
    CITIES,
    EMPLOYEES,
    EVENT_LINES,
    ORDERS,
    RATINGS,
    VISITS,
    access_lines,
    cities,
    employees,
    event_lines,
    orders,
    ratings,
    table,
    visits,
    with_ctes,
)
from tallyloom.operators import aggregates as agg
from tallyloom.operators.enrich import enrich_user_agent
from tallyloom.operators.joins import clicks_join_city, clicks_left_join_city
from tallyloom.operators.parsing import parse_access_log, parse_event_log
from tallyloom.plans.area_top_products import product_clicks

WORDS = r"""
words AS (
  SELECT unnest(regexp_split_to_array(regexp_replace(text, '\s+$', ''), '\s+')) AS word FROM documents)"""


@query("word_count", with_ctes(WORDS) + "SELECT word, count(*) AS cnt FROM words GROUP BY word")
def _word_count(spark, sf_dir):
    return agg.word_count(table(spark, sf_dir, "documents"), "text")


def _log(spark, sf_dir):
    return parse_access_log(access_lines(spark, sf_dir))


@query(
    "content_size_stats",
    with_ctes(ACCESS_LINES)
    + """SELECT avg(content_size) AS avg_size, min(content_size) AS min_size,
         max(content_size) AS max_size FROM access_log""",
)
def _content_size_stats(spark, sf_dir):
    return agg.content_size_stats(_log(spark, sf_dir))


def _top(column: str, n: int, having: str = "") -> str:
    return (
        with_ctes(ACCESS_LINES)
        + f"SELECT {column}, count(*) AS cnt FROM access_log GROUP BY {column} {having} "
        + f"ORDER BY cnt DESC, {column} LIMIT {n}"
    )


@query("response_code_counts", _top("response_code", 20))
def _response_code_counts(spark, sf_dir):
    return agg.response_code_counts(_log(spark, sf_dir))


@query("frequent_ips", _top("ip_address", 20, "HAVING count(*) > 30"))
def _frequent_ips(spark, sf_dir):
    return agg.frequent_ips(_log(spark, sf_dir))


@query("top_endpoints", _top("endpoint", 5))
def _top_endpoints(spark, sf_dir):
    return agg.top_endpoints(_log(spark, sf_dir))


@query(
    "sum_rounded",
    "SELECT CAST(round(sum(CAST(o_totalprice AS DECIMAL(28,6))), 2) AS DOUBLE) AS sum_amt FROM orders",
)
def _sum_rounded(spark, sf_dir):
    return agg.sum_rounded(table(spark, sf_dir, "orders"), "o_totalprice")


@query(
    "user_order_count",
    """SELECT o_custkey, count(*) AS cnt FROM orders WHERE o_totalprice > 50
       GROUP BY o_custkey HAVING count(*) >= 2 ORDER BY cnt DESC, o_custkey LIMIT 5""",
)
def _user_order_count(spark, sf_dir):
    return agg.user_order_count(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")


# Halves are rounded away from zero on both sides.
_AVG = "round(avg({0}) + 1e-9 * sign(avg({0})), 2)"


@query(
    "movie_rating_summary",
    with_ctes(RATINGS)
    + f"""SELECT item_id, count(item_id) AS cnt, {_AVG.format('rating')} AS avg_rating FROM ratings
          GROUP BY item_id HAVING count(item_id) > 20 ORDER BY cnt DESC, avg_rating DESC, item_id LIMIT 20""",
)
def _movie_rating_summary(spark, sf_dir):
    return agg.movie_rating_summary(ratings(spark, sf_dir), "item_id", "rating", min_count=20)


@query(
    "dept_avg_salary",
    with_ctes(EMPLOYEES) + f"SELECT deptno, {_AVG.format('sal')} AS avg_sal FROM employees GROUP BY deptno",
)
def _dept_avg_salary(spark, sf_dir):
    return agg.dept_avg_salary(employees(spark, sf_dir), "deptno", "sal")


@query(
    "avg_udaf",
    with_ctes(EMPLOYEES) + "SELECT deptno, round(avg(sal), 6) AS avg_value FROM employees GROUP BY deptno",
)
def _avg_udaf(spark, sf_dir):
    result = agg.avg_udaf(employees(spark, sf_dir), "deptno", "sal")
    return result.withColumn("avg_value", F.round("avg_value", 6))


CLICKS = (
    """
clicks AS (
  SELECT area, click_product_id, v.city_id, city_name
  FROM visits v LEFT JOIN cities c ON v.city_id = c.city_id WHERE click_product_id <> '')"""
)
AREA_CLICKS = """
area_clicks AS (
  SELECT area, click_product_id, CAST(sum(n) AS BIGINT) AS click_count,
         string_agg(city_id || ':' || city_name || ':' || n, ',' ORDER BY city_id) AS city_infos
  FROM (SELECT area, click_product_id, city_id, city_name, count(*) AS n FROM clicks GROUP BY ALL)
  GROUP BY area, click_product_id)"""


def located_clicks(spark, sf_dir):
    return clicks_left_join_city(product_clicks(visits(spark, sf_dir)), cities(spark, sf_dir))


@query(
    "group_concat_distinct",
    with_ctes(VISITS, CITIES, CLICKS, AREA_CLICKS)
    + "SELECT area, click_product_id, city_infos FROM area_clicks",
)
def _group_concat_distinct(spark, sf_dir):
    keys = ["area", "click_product_id"]
    return agg.group_concat_distinct(located_clicks(spark, sf_dir), keys, "city_id", "city_name", "city_infos")


@query(
    "conditional_count",
    with_ctes(VISITS, CITIES)
    + """SELECT area, click_product_id,
         count(CASE WHEN length(click_product_id) > 0 THEN click_product_id END) AS cnt
         FROM visits v JOIN cities c ON v.city_id = c.city_id GROUP BY area, click_product_id""",
)
def _conditional_count(spark, sf_dir):
    located = clicks_join_city(visits(spark, sf_dir), cities(spark, sf_dir))
    return agg.conditional_count(located, ["area", "click_product_id"], "click_product_id")


@query(
    "area_product_clicks",
    with_ctes(VISITS, CITIES, CLICKS, AREA_CLICKS) + "SELECT * FROM area_clicks",
)
def _area_product_clicks(spark, sf_dir):
    return agg.area_product_clicks(located_clicks(spark, sf_dir))


NEW_USERS = """
new_users AS (
  SELECT day(make_timestamp(CAST(trunc(CAST(s_time AS DOUBLE) * 1000) AS BIGINT) * 1000)) AS day,
         CASE WHEN pl IS NULL THEN 'unknown:unknown' WHEN ver IS NULL THEN pl || ':unknown'
              ELSE pl || ':' || ver END AS platform_dimension,
         CASE WHEN browser IS NULL THEN 'unknown:unknown'
              ELSE browser || ':' || split_part(browser_v, '.', 1) END AS browser_dimension
  FROM event_lines WHERE en = 'e_l')"""


def _events(spark, sf_dir):
    field = F.col("fields")
    names = ["en", "u_ud", "s_time", "pl", "ver", "b_iev"]
    parsed = parse_event_log(event_lines(spark, sf_dir)).select(*[field[n].alias(n) for n in names])
    return enrich_user_agent(parsed, "b_iev")


@query(
    "new_users_by_platform",
    with_ctes(EVENT_LINES, NEW_USERS)
    + """SELECT CAST(day AS INTEGER) AS day, platform_dimension, count(*) AS new_users
         FROM new_users GROUP BY ALL""",
)
def _new_users_by_platform(spark, sf_dir):
    return agg.new_users_by_platform(_events(spark, sf_dir))


@query(
    "new_users_by_platform_browser",
    with_ctes(EVENT_LINES, NEW_USERS)
    + """SELECT CAST(day AS INTEGER) AS day, platform_dimension, browser_dimension, count(*) AS new_users
         FROM new_users GROUP BY ALL""",
)
def _new_users_by_platform_browser(spark, sf_dir):
    return agg.new_users_by_platform_browser(_events(spark, sf_dir))


@query(
    "new_users_both",
    with_ctes(EVENT_LINES, NEW_USERS)
    + """SELECT CAST(day AS INTEGER) AS day, platform_dimension, browser_dimension, count(*) AS new_users
         FROM new_users GROUP BY GROUPING SETS ((1, 2, 3), (1, 2))""",
)
def _new_users_both(spark, sf_dir):
    return agg.new_users_both(_events(spark, sf_dir))


@query("class_distribution", "SELECT lang, count(*) AS cnt FROM documents GROUP BY lang")
def _class_distribution(spark, sf_dir):
    return agg.class_distribution(table(spark, sf_dir, "documents"), "lang")


@query(
    "cache_reused",
    with_ctes(ORDERS)
    + """SELECT order_type AS label, count(*) AS cnt FROM order_rows GROUP BY 1
         UNION ALL SELECT CAST(province_id AS VARCHAR), count(*) FROM order_rows GROUP BY 1""",
)
def _cache_reused(spark, sf_dir):
    """Two counts of one input that is read once: each is written while it is kept."""
    from tallyloom.operators.routing import cache_reused
    from tallyloom.shared_folder import staged

    with cache_reused(orders(spark, sf_dir)) as kept:
        kinds = staged(agg.class_distribution(kept, "order_type"), "kinds")
        places = staged(agg.class_distribution(kept, "province_id"), "places")
    label = F.col("province_id").cast("string").alias("label")
    return kinds.select(F.col("order_type").alias("label"), "cnt").union(places.select(label, "cnt"))
