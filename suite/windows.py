"""Streaming transformations on static input: the batch twins of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.joins import black_users, white_users
from suite.registry import query
from suite.tables import (
    AD_CLICKS,
    AD_STATE,
    ORDERS,
    ad_clicks,
    orders,
    table,
    with_ctes,
)
from tallyloom.operators.membership import membership_bits, merged_bits
from tallyloom.shared_folder import staged
from tallyloom.sources.streams import stream_union
from tallyloom.streaming import blacklist, ingest, state, windows

def window_cte(name: str, source: str, columns: str, size: int, slide: int) -> str:
    """Rows of ``source`` once for each window they lie in; starts are multiples of the slide."""
    steps = (size + slide - 1) // slide
    return f"""
{name} AS (
  SELECT {columns}, make_timestamp(s * 1000000) AS window_start,
         make_timestamp((s + {size}) * 1000000) AS window_end
  FROM (SELECT *, (epoch_us(ts) // 1000000 // {slide} - unnest(range({steps}))) * {slide} AS s FROM {source})
  WHERE s + {size} > epoch_us(ts) // 1000000)"""


HOUR, DAY = 3600, 86400
_MESSAGES = """
messages AS (SELECT ts, event_type || ' k' || regexp_extract(props, '"k": *([0-9]+)', 1) AS "value" FROM events),
words AS (SELECT ts, unnest(string_split("value", ' ')) AS word FROM messages)"""


def message_columns(events):
    line = F.concat("event_type", F.lit(" k"), F.get_json_object("props", "$.k"))
    return events.select("ts", line.alias("value"))


_WINDOW_WORDS = (
    with_ctes(_MESSAGES, window_cte("w", "words", "word", 9 * HOUR, 6 * HOUR))
    + "SELECT window_start, window_end, word, count(*) AS cnt FROM w GROUP BY ALL"
)


@query("window_word_count", _WINDOW_WORDS)
def _window_word_count(spark, sf_dir):
    lines = message_columns(table(spark, sf_dir, "events"))
    return windows.window_word_count(lines, size="9 hours", slide="6 hours")


@query("window_word_count_incremental", _WINDOW_WORDS)
def _window_word_count_incremental(spark, sf_dir):
    lines = message_columns(table(spark, sf_dir, "events"))
    return windows.window_word_count_incremental(lines, size="9 hours", slide="6 hours")


@query(
    "stream_word_count",
    with_ctes(_MESSAGES) + "SELECT word, count(*) AS cnt FROM words GROUP BY word",
)
def _stream_word_count(spark, sf_dir):
    return state.stream_word_count(message_columns(table(spark, sf_dir, "events")))


TOTALS = (
    with_ctes(ORDERS)
    + """SELECT province_id, CAST(sum(CAST(order_price AS DECIMAL(28,6))) AS DOUBLE) AS total
         FROM order_rows GROUP BY province_id"""
)


@query("order_total_by_province", TOTALS)
def _order_total_by_province(spark, sf_dir):
    return state.order_total_by_province(orders(spark, sf_dir))


@query("order_total_mapped_state", TOTALS)
def _order_total_mapped_state(spark, sf_dir):
    return state.order_total_mapped_state(orders(spark, sf_dir))


_ORDER_WINDOWS = with_ctes(ORDERS, window_cte("w", "order_rows", "province_id", 20 * DAY, 10 * DAY))


@query(
    "window_order_count",
    _ORDER_WINDOWS + "SELECT window_start, window_end, province_id, count(*) AS cnt FROM w GROUP BY ALL",
)
def _window_order_count(spark, sf_dir):
    return windows.window_order_count(orders(spark, sf_dir), "ts", "20 days", "10 days")


TOP_WINDOWS = (
    with_ctes(ORDERS, window_cte("w", "order_rows", "province_id", 20 * DAY, 8 * DAY))
    + """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, province_id)
         AS INTEGER) AS rank FROM (SELECT window_start, window_end, province_id, count(*) AS cnt
         FROM w GROUP BY ALL)) WHERE rank <= 5"""
)


@query("window_top5_provinces", TOP_WINDOWS)
def _window_top5_provinces(spark, sf_dir):
    return windows.window_top5_provinces(orders(spark, sf_dir), "ts", "20 days", "8 days")


DYNAMIC = (
    with_ctes(AD_CLICKS, window_cte("w", "ad_clicks", "user_id", 60 * HOUR, 18 * HOUR))
    + """SELECT DISTINCT user_id FROM (SELECT user_id, window_start FROM w GROUP BY ALL HAVING count(*) > 10)
         WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)"""
)


@query("dynamic_blacklist", DYNAMIC)
def _dynamic_blacklist(spark, sf_dir):
    clicks, white = ad_clicks(spark, sf_dir), white_users(spark, sf_dir)
    return windows.dynamic_blacklist(clicks, white, "60 hours", "18 hours", 10)


@query("dynamic_blacklist_inclusive", DYNAMIC.replace("count(*) > 10", "count(*) >= 10"))
def _dynamic_blacklist_inclusive(spark, sf_dir):
    clicks, white = ad_clicks(spark, sf_dir), white_users(spark, sf_dir)
    return windows.dynamic_blacklist(clicks, white, "60 hours", "18 hours", 10, inclusive=True)


@query(
    "filter_blacklisted_stream",
    with_ctes(AD_CLICKS)
    + """SELECT * FROM ad_clicks WHERE user_id NOT IN
         (SELECT user_id FROM ad_clicks GROUP BY user_id HAVING count(*) > 70)""",
)
def _filter_blacklisted_stream(spark, sf_dir):
    black = staged(black_users(spark, sf_dir), "blacklist")
    return blacklist.filter_blacklisted_stream(ad_clicks(spark, sf_dir), black)


@query(
    "filter_blacklisted_long_list",
    with_ctes(AD_CLICKS)
    + """SELECT * FROM ad_clicks WHERE user_id NOT IN
         (SELECT user_id FROM ad_clicks GROUP BY user_id HAVING count(*) > 3 AND user_id % 4 > 0)""",
)
def _filter_blacklisted_long_list(spark, sf_dir):
    """A list above the bound for a broadcast: its filter, made in two parts and merged, spares most clicks the shuffle."""
    counts = ad_clicks(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    black = staged(counts.where("cnt > 3 AND user_id % 4 > 0").select("user_id"), "blacklist")
    halves = [membership_bits(black.where(F.col("user_id") % 2 == n), "user_id") for n in (0, 1)]
    bits = staged(merged_bits(halves[0].unionByName(halves[1])), "blacklist-bits")
    return blacklist.filter_blacklisted_stream(ad_clicks(spark, sf_dir), black, bits=bits, max_rows=10)


AD_STATE_SQL = with_ctes(AD_CLICKS, AD_STATE) + "SELECT * FROM state"


@query("ad_click_state", AD_STATE_SQL)
def _ad_click_state(spark, sf_dir):
    return state.ad_click_state(ad_clicks(spark, sf_dir))


@query(
    "ad_click_state_mapped",
    with_ctes(AD_CLICKS)
    + """SELECT strftime(ts, '%Y-%m-%d') || ':' || province || ':' || ad_id AS state_key,
         count(*) AS click_count FROM ad_clicks GROUP BY ALL""",
)
def _ad_click_state_mapped(spark, sf_dir):
    return state.ad_click_state_mapped(ad_clicks(spark, sf_dir))


# A click opens a period if the one before it is more than twelve hours away.
AD_PERIODS = (
    with_ctes(AD_CLICKS)
    + """, marked AS (
           SELECT *, strftime(ts, '%Y%m%d') AS date, CASE WHEN ts - lag(ts) OVER (
             PARTITION BY strftime(ts, '%Y%m%d'), province, city, ad_id ORDER BY ts) <= INTERVAL 12 HOUR
             THEN 0 ELSE 1 END AS opens FROM ad_clicks),
         numbered AS (
           SELECT *, sum(opens) OVER (PARTITION BY date, province, city, ad_id ORDER BY ts
             ROWS UNBOUNDED PRECEDING) AS period FROM marked),
         periods AS (
           SELECT date, province, city, ad_id, min(ts) AS period_start,
                  max(ts) + INTERVAL 12 HOUR AS period_end, count(*) AS click_count
           FROM numbered GROUP BY date, province, city, ad_id, period) """
)


@query("ad_click_state_expiring", AD_PERIODS + "SELECT * FROM periods")
def _ad_click_state_expiring(spark, sf_dir):
    return state.ad_click_state_expiring(ad_clicks(spark, sf_dir), idle="12 hours")


_AD_WINDOWS = with_ctes(AD_CLICKS, window_cte("w", "ad_clicks", "ad_id", 10 * HOUR, HOUR))
_BOUND = "strftime(window_{0}, '%Y/%m/%d %H:%M:%S')"


@query(
    "ad_click_window",
    _AD_WINDOWS
    + f"""SELECT {_BOUND.format('start')} AS window_start, {_BOUND.format('end')} AS window_end, ad_id,
          count(*) AS click_count FROM w GROUP BY ALL""",
)
def _ad_click_window(spark, sf_dir):
    return windows.ad_click_window(ad_clicks(spark, sf_dir), "10 hours", "1 hour")


@query(
    "ad_click_window_packed",
    _AD_WINDOWS
    + f"""SELECT {_BOUND.format('start')} || ':' || {_BOUND.format('end')} || ',' || ad_id AS "key",
          CAST(count(*) AS VARCHAR) AS "value" FROM w GROUP BY ALL""",
)
def _ad_click_window_packed(spark, sf_dir):
    return windows.ad_click_window_packed(ad_clicks(spark, sf_dir), "10 hours", "1 hour")


@query(
    "stream_union",
    "SELECT event_id FROM events UNION ALL SELECT o_orderkey FROM orders",
)
def _stream_union(spark, sf_dir):
    return stream_union(
        table(spark, sf_dir, "events").select("event_id"),
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id")),
    )


CELLS = """SELECT event_type AS "table", CAST(event_id AS VARCHAR) AS rowkey, 'info' AS family,
 unnest(['user_id', 'value']) AS qualifier, unnest([CAST(user_id AS VARCHAR), props]) AS "value" FROM events"""


def topic_messages(events):
    """Events as topic messages with two cells each; the type is the topic."""
    message = F.struct(
        F.col("event_id").cast("string").alias("r"),
        F.lit("info").alias("f"),
        F.array(F.lit("user_id"), F.lit("value")).alias("q"),
        F.array(F.col("user_id").cast("string"), F.col("props")).alias("v"),
    )
    return events.select(F.col("event_type").alias("topic"), F.to_json(message).alias("value"))


@query("topic_ingest_exactly", CELLS)
def _topic_ingest_exactly(spark, sf_dir):
    return ingest.topic_ingest_exactly(topic_messages(table(spark, sf_dir, "events")))
