"""Top-N within groups and overall."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.aggregates import AREA_CLICKS, CLICKS, WORDS, located_clicks
from suite.registry import query
from suite.tables import AD_CLICKS, AD_STATE, CITIES, VISITS, ad_clicks, table, with_ctes
from tallyloom.operators import topn
from tallyloom.operators.aggregates import word_count
from tallyloom.streaming.state import ad_click_state

_TOP_VALUES = """
SELECT l_partkey, list(l_quantity ORDER BY l_quantity DESC) AS top_values
FROM (SELECT l_partkey, l_quantity,
      row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC) AS r FROM lineitem)
WHERE r <= 3 GROUP BY l_partkey"""
# Lists as text, which every comparison of values can read.
_TOP_TEXT = f"SELECT l_partkey, list_aggregate(list_transform(top_values, lambda v: CAST(CAST(v AS INTEGER) AS VARCHAR)), 'string_agg', ',') AS top_values FROM ({_TOP_VALUES})"


def _as_text(df):
    return df.withColumn("top_values", F.array_join(F.transform("top_values", lambda v: v.cast("int").cast("string")), ","))


@query("group_topn_values", _TOP_TEXT)
def _group_topn_values(spark, sf_dir):
    return _as_text(topn.group_topn_values(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity"))


@query("group_topn_salted", _TOP_TEXT)
def _group_topn_salted(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return _as_text(topn.group_topn_salted(items, "l_partkey", "l_quantity", salts=8))


_COUNTS = WORDS + ", counts AS (SELECT word, count(*) AS cnt FROM words GROUP BY word)"


def _counts(spark, sf_dir):
    return word_count(table(spark, sf_dir, "documents"), "text")


@query("sort_all_desc", "WITH" + _COUNTS + "SELECT * FROM counts ORDER BY cnt DESC, word DESC")
def _sort_all_desc(spark, sf_dir):
    return topn.sort_all_desc(_counts(spark, sf_dir), "cnt", "word")


@query("bottom_k", "WITH" + _COUNTS + "SELECT * FROM counts ORDER BY cnt, word LIMIT 3")
def _bottom_k(spark, sf_dir):
    return topn.bottom_k(_counts(spark, sf_dir), ["cnt", "word"])


@query("top_k", "WITH" + _COUNTS + "SELECT * FROM counts ORDER BY cnt DESC, word DESC LIMIT 3")
def _top_k(spark, sf_dir):
    return topn.top_k(_counts(spark, sf_dir), ["cnt", "word"])


@query("top_k_custom_order", "WITH" + _COUNTS + "SELECT * FROM counts ORDER BY cnt DESC, word LIMIT 3")
def _top_k_custom_order(spark, sf_dir):
    return topn.top_k_custom_order(_counts(spark, sf_dir), F.col("cnt"), "word")


@query(
    "area_top_products",
    with_ctes(VISITS, CITIES, CLICKS, AREA_CLICKS)
    + """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY area
         ORDER BY click_count DESC, click_product_id) AS INTEGER) AS rank FROM area_clicks) WHERE rank <= 10""",
)
def _area_top_products(spark, sf_dir):
    return topn.area_top_products(located_clicks(spark, sf_dir))


_RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) - 1 AS rank
  FROM (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM state GROUP BY date, province, ad_id))"""


@query(
    "province_top5_ads",
    with_ctes(AD_CLICKS, AD_STATE, _RANKED)
    + """SELECT date, province, ad_id, click_count, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank < 5""",
)
def _province_top5_ads(spark, sf_dir):
    return topn.province_top5_ads(ad_click_state(ad_clicks(spark, sf_dir)))


@query(
    "province_top5_packed",
    with_ctes(AD_CLICKS, AD_STATE, _RANKED)
    + """SELECT date || ':' || province AS "key",
         string_agg(ad_id || ':' || click_count, ',' ORDER BY rank) AS "value"
         FROM ranked WHERE rank < 5 GROUP BY date, province""",
)
def _province_top5_packed(spark, sf_dir):
    return topn.province_top5_packed(ad_click_state(ad_clicks(spark, sf_dir)))


@query(
    "province_top5_ads_sql",
    with_ctes(AD_CLICKS)
    + """SELECT date, province, ad_id, click_count FROM (
         SELECT *, row_number() OVER (PARTITION BY province ORDER BY click_count DESC, date, ad_id) AS r
         FROM (SELECT strftime(ts, '%Y%m%d') AS date, province, ad_id, count(*) AS click_count
               FROM ad_clicks GROUP BY ALL)) WHERE r <= 5""",
)
def _province_top5_ads_sql(spark, sf_dir):
    state = ad_click_state(ad_clicks(spark, sf_dir))
    by_ad = state.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))
    return topn.province_top5_ads_sql(by_ad)
