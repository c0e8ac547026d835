"""Parsing, cleaning and enrichment."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from suite.aggregates import NEW_USERS
from suite.registry import query
from suite.tables import (
    ACCESS_LINES,
    AD_CLICKS,
    ADDRESS_RANGES,
    CITIES,
    EVENT_LINES,
    ORDERS,
    PRODUCTS,
    VISITS,
    access_lines,
    ad_clicks,
    address_ranges,
    cities,
    employees,
    event_lines,
    orders,
    products,
    table,
    visits,
    with_ctes,
)
from tallyloom.functions import text
from tallyloom.functions.dates import server_time_to_millis
from tallyloom.functions.registry import register_functions
from tallyloom.operators import enrich, parsing
from tallyloom.plans.event_log import load_event_cells, load_events, new_users_of_cells
from tallyloom.shared_folder import new_path


@query("parse_access_log", with_ctes(ACCESS_LINES) + "SELECT * FROM access_log")
def _parse_access_log(spark, sf_dir):
    return parsing.parse_access_log(access_lines(spark, sf_dir))


@query(
    "parse_access_log_split",
    with_ctes(ACCESS_LINES)
    + "SELECT * REPLACE (split_part(date_time, ' ', 1) AS date_time) FROM access_log",
)
def _parse_access_log_split(spark, sf_dir):
    return parsing.parse_access_log_split(access_lines(spark, sf_dir))


_PRICE = "CAST(CAST(order_price AS DECIMAL(18,2)) AS VARCHAR)"


@query(
    "parse_orders_csv",
    with_ctes(ORDERS)
    + "SELECT order_id, province_id, order_price FROM order_rows WHERE order_type IS NOT NULL",
)
def _parse_orders_csv(spark, sf_dir):
    """Orders without a type become lines with too few fields."""
    price = F.col("order_price").cast("decimal(18,2)").cast("string")
    full = F.concat_ws(",", "order_id", F.col("province_id").cast("string"), price, "order_type")
    line = F.when(F.col("order_type").isNull(), F.concat("order_id", F.lit(",,"))).otherwise(full)
    return parsing.parse_orders_csv(orders(spark, sf_dir).select(line.alias("value")))


@query(
    "parse_orders_json",
    with_ctes(ORDERS) + "SELECT order_id, province_id, order_price FROM order_rows",
)
def _parse_orders_json(spark, sf_dir):
    order = F.struct(
        F.col("order_id").alias("orderId"),
        F.col("province_id").alias("provinceId"),
        F.col("order_price").alias("orderPrice"),
    )
    return parsing.parse_orders_json(orders(spark, sf_dir).select(F.to_json(order).alias("value")))


def _click_lines(spark, sf_dir):
    """Every seventh event has one word too many, every eleventh one too few."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    user, ad = F.col("user_id").cast("string"), F.col("ad_id").cast("string")
    four = F.concat_ws(" ", ms, "province", "city", user)
    line = (
        F.when(F.col("event_id") % 11 == 0, four)
        .when(F.col("event_id") % 7 == 0, F.concat_ws("  ", four, ad, F.lit("extra")))
        .otherwise(F.concat_ws("  ", four, ad))
    )
    return ad_clicks(spark, sf_dir).select(line.alias("value"))


_CLICK_COLUMNS = "SELECT epoch_us(ts) // 1000 AS ts_ms, province, city, user_id, ad_id FROM ad_clicks "


@query(
    "parse_ad_clicks",
    with_ctes(AD_CLICKS) + _CLICK_COLUMNS + "WHERE event_id % 11 <> 0 AND event_id % 7 <> 0",
)
def _parse_ad_clicks(spark, sf_dir):
    return parsing.parse_ad_clicks(_click_lines(spark, sf_dir))


@query("parse_ad_clicks_at_least", with_ctes(AD_CLICKS) + _CLICK_COLUMNS + "WHERE event_id % 11 <> 0")
def _parse_ad_clicks_at_least(spark, sf_dir):
    return parsing.parse_ad_clicks(_click_lines(spark, sf_dir), exact=False)


_FIELDS = ["ip", "s_time", "http_host", "en", "u_ud", "u_mid", "pl", "ver", "b_iev"]


@query("parse_event_log", with_ctes(EVENT_LINES) + f"SELECT event_id, {', '.join(_FIELDS)} FROM event_lines")
def _parse_event_log(spark, sf_dir):
    parsed = parsing.parse_event_log(event_lines(spark, sf_dir), keep=["event_id"])
    return parsed.select("event_id", *[F.col("fields")[f].alias(f) for f in _FIELDS])


@query(
    "filter_event_types",
    with_ctes(EVENT_LINES)
    + "SELECT en, count(*) AS cnt FROM event_lines WHERE en IN ('e_l','e_pv','e_crt','e_cs','e_cr','e_e') GROUP BY en",
)
def _filter_event_types(spark, sf_dir):
    parsed = parsing.parse_event_log(event_lines(spark, sf_dir))
    known = parsing.filter_event_types(parsed.select(F.col("fields")["en"].alias("en")))
    return known.groupBy("en").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "enrich_region",
    with_ctes(EVENT_LINES, ADDRESS_RANGES)
    + """SELECT event_id, ip, '中国' AS country,
         CASE WHEN lo IS NULL THEN '上海市' ELSE province || '省' END AS province,
         CASE WHEN lo IS NULL THEN 'unknown' ELSE city || '市' END AS city
         FROM (SELECT *, 167772160 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256
                 + CAST(split_part(ip, '.', 4) AS BIGINT) AS n FROM event_lines)
         LEFT JOIN ranges ON n BETWEEN lo AND hi""",
)
def _enrich_region(spark, sf_dir):
    parsed = parsing.parse_event_log(event_lines(spark, sf_dir), keep=["event_id"])
    events = parsed.select("event_id", F.col("fields")["ip"].alias("ip"))
    return enrich.enrich_region(events, "ip", address_ranges(spark, sf_dir))


@query(
    "enrich_user_agent",
    with_ctes(EVENT_LINES) + "SELECT event_id, browser, browser_v, os, os_v FROM event_lines",
)
def _enrich_user_agent(spark, sf_dir):
    parsed = parsing.parse_event_log(event_lines(spark, sf_dir), keep=["event_id"])
    events = parsed.select("event_id", F.col("fields")["b_iev"].alias("ua"))
    return enrich.enrich_user_agent(events, "ua").drop("ua")


# CRC-32 by its table of 256 entries, which eight shift steps of each number give.
_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
_CRC_TABLE = """
step0 AS (SELECT i, i::BIGINT AS c FROM range(256) t(i)),""" + ",".join(
    f"\nstep{n + 1} AS (SELECT i, {_STEP} AS c FROM step{n})" for n in range(8)
) + """,
crc_table AS (SELECT list(c ORDER BY i) AS t FROM step8)"""


@query(
    "event_row_key",
    with_ctes(EVENT_LINES, _CRC_TABLE)
    + """, keyed AS (
           SELECT event_id, CAST(trunc(CAST(s_time AS DOUBLE) * 1000) AS BIGINT) AS ms,
                  list_transform(string_split(u_ud || u_mid || en, ''), lambda ch: ascii(ch)::BIGINT) AS bytes
           FROM event_lines)
         SELECT event_id, ms || '_' || xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
           lambda crc, b: xor(crc // 256, t[(xor(crc, b) & 255) + 1]))) % 1000000000 AS row_key
         FROM keyed, crc_table""",
)
def _event_row_key(spark, sf_dir):
    parsed = parsing.parse_event_log(event_lines(spark, sf_dir), keep=["event_id"])
    field = F.col("fields")
    key = text.event_row_key(server_time_to_millis(field["s_time"]), field["u_ud"], field["u_mid"], field["en"])
    return parsed.select("event_id", key.alias("row_key"))


# The row key of each line: milliseconds and a checksum of user, member and event name.
_KEYED_LINES = (
    _CRC_TABLE
    + """,
lines_in_bytes AS (
  SELECT *, CAST(trunc(CAST(s_time AS DOUBLE) * 1000) AS BIGINT) AS ms,
         list_transform(string_split(u_ud || u_mid || en, ''), lambda ch: ascii(ch)::BIGINT) AS bytes,
         167772160 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS n
  FROM event_lines),
keyed_lines AS (
  SELECT *, ms || '_' || xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda crc, b: xor(crc // 256, t[(xor(crc, b) & 255) + 1]))) % 1000000000 AS row_key
  FROM lines_in_bytes, crc_table)"""
)
_ETL_FIELDS = "ip s_time http_host en u_ud u_mid pl ver b_iev country province city browser browser_v os os_v".split()
EVENT_CELLS = (
    with_ctes(EVENT_LINES, ADDRESS_RANGES, _KEYED_LINES)
    + f""", regioned AS (
           SELECT k.*, '中国' AS country, CASE WHEN lo IS NULL THEN '上海市' ELSE r.province || '省' END AS province,
                  CASE WHEN lo IS NULL THEN 'unknown' ELSE r.city || '市' END AS city
           FROM keyed_lines k LEFT JOIN ranges r ON n BETWEEN lo AND hi WHERE en <> 'e_x'),
         cells AS (
           SELECT row_key AS rowkey, 'info' AS family, unnest({_ETL_FIELDS}) AS qualifier,
                  unnest([{", ".join(_ETL_FIELDS)}]) AS "value" FROM regioned)
         SELECT * FROM cells WHERE "value" IS NOT NULL"""
)


@query("event_log_etl", EVENT_CELLS)
def _event_log_etl(spark, sf_dir):
    """The whole job: lines parsed, cleaned and given regions and agents, and every cell of the day read back."""
    lines = event_lines(spark, sf_dir).select("value")
    path = load_events(lines, new_path(spark, "events"), "2024-01-01", address_ranges(spark, sf_dir))
    return spark.read.parquet(path)


@query("event_cells_clustered", EVENT_CELLS.replace("SELECT * FROM cells", "SELECT DISTINCT * FROM cells"))
def _event_cells_clustered(spark, sf_dir):
    """The same cells in a table that is clustered by row key: each is there once."""
    return spark.table(_event_table(spark, sf_dir)).select("rowkey", "family", "qualifier", "value")


def _event_table(spark, sf_dir) -> str:
    name = f"event_logs_{uuid.uuid4().hex}"
    lines = event_lines(spark, sf_dir).select("value")
    load_event_cells(lines, name, new_path(spark, "event-cells"), address_ranges(spark, sf_dir), buckets=8)
    return name


@query(
    "new_users_from_cells",
    with_ctes(EVENT_LINES, NEW_USERS.replace("FROM event_lines", "FROM (SELECT DISTINCT * EXCLUDE (event_id) FROM event_lines)"))
    + """SELECT CAST(day AS INTEGER) AS day, platform_dimension, browser_dimension, count(*) AS new_users
         FROM new_users GROUP BY GROUPING SETS ((1, 2, 3), (1, 2))""",
)
def _new_users_from_cells(spark, sf_dir):
    """New users out of the cells that the loading job wrote, regions and all."""
    return new_users_of_cells(spark, _event_table(spark, sf_dir))


@query(
    "platform_dimension",
    with_ctes(EVENT_LINES)
    + """SELECT CASE WHEN pl IS NULL THEN 'unknown:unknown' WHEN ver IS NULL THEN pl || ':unknown'
         ELSE pl || ':' || ver END AS platform_dimension, count(*) AS cnt FROM event_lines GROUP BY ALL""",
)
def _platform_dimension(spark, sf_dir):
    field = parsing.parse_event_log(event_lines(spark, sf_dir)).select("fields.pl", "fields.ver")
    dim = text.platform_dimension(F.col("pl"), F.col("ver")).alias("platform_dimension")
    return field.groupBy(dim).agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "browser_dimension",
    with_ctes(EVENT_LINES)
    + """SELECT CASE WHEN browser IS NULL THEN 'unknown:unknown'
         ELSE browser || ':' || split_part(browser_v, '.', 1) END AS browser_dimension, count(*) AS cnt
         FROM event_lines GROUP BY ALL""",
)
def _browser_dimension(spark, sf_dir):
    parsed = parsing.parse_event_log(event_lines(spark, sf_dir)).select(F.col("fields")["b_iev"].alias("ua"))
    agents = enrich.enrich_user_agent(parsed, "ua")
    dim = text.browser_dimension(F.col("browser"), F.col("browser_v")).alias("browser_dimension")
    return agents.groupBy(dim).agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "is_not_empty",
    with_ctes(VISITS)
    + "SELECT click_product_id <> '' AS is_click, count(*) AS cnt FROM visits GROUP BY ALL",
)
def _is_not_empty(spark, sf_dir):
    test = text.is_not_empty(F.col("click_product_id")).alias("is_click")
    return visits(spark, sf_dir).groupBy(test).agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "optional_date_range",
    with_ctes(VISITS)
    + "SELECT date_part, count(*) AS cnt FROM visits WHERE date_part >= '1996-03-01' AND date_part <= '1996-09-30' GROUP BY ALL",
)
def _optional_date_range(spark, sf_dir):
    kept = parsing.optional_date_range(visits(spark, sf_dir), "date_part", "1996-03-01", "1996-09-30")
    return kept.groupBy("date_part").agg(F.count(F.lit(1)).alias("cnt"))


@query("concat_int_string", with_ctes(CITIES) + "SELECT city_id || ':' || city_name AS city FROM cities")
def _concat_int_string(spark, sf_dir):
    return cities(spark, sf_dir).select(
        text.concat_int_string(F.col("city_id"), F.col("city_name")).alias("city")
    )


@query("json_string_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _json_string_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.json_string_field(F.col("props"), "k").alias("k")
    )


@query(
    "area_level",
    with_ctes(CITIES)
    + """SELECT city_id, CASE area WHEN 'AFRICA' THEN 'A' WHEN 'AMERICA' THEN 'B' WHEN 'ASIA' THEN 'C'
         WHEN 'EUROPE' THEN 'D' ELSE 'E' END AS area_level FROM cities""",
)
def _area_level(spark, sf_dir):
    from suite.tables import AREA_LEVELS

    level = text.area_level(F.col("area"), AREA_LEVELS).alias("area_level")
    return cities(spark, sf_dir).select("city_id", level)


@query(
    "product_type_label",
    with_ctes(PRODUCTS)
    + """SELECT product_id, CASE WHEN json_extract_string(extend_info, '$.product_type') = '0'
         THEN '自营商品' ELSE '第三方商品' END AS product_type FROM products""",
)
def _product_type_label(spark, sf_dir):
    label = text.product_type_label(F.col("extend_info")).alias("product_type")
    return products(spark, sf_dir).select("product_id", label)


@query("first_segment", "SELECT p_partkey, split_part(p_name, ' ', 1) AS color FROM part WHERE length(trim(p_name)) > 0")
def _first_segment(spark, sf_dir):
    """The first part of ``color;kind``, made from part names."""
    info = F.replace(F.col("p_name"), F.lit(" "), F.lit(";")).alias("size_info")
    parts = table(spark, sf_dir, "part").select("p_partkey", info)
    kept = parts.filter(~text.is_blank(F.col("size_info")))
    return kept.select("p_partkey", text.first_segment(F.col("size_info")).alias("color"))


@query(
    "project_filter_sort",
    """SELECT c_name AS ename, c_acctbal AS sal, row_number() OVER (ORDER BY c_acctbal DESC, c_name) - 1 AS place
       FROM customer WHERE c_acctbal > 1500 AND c_mktsegment = 'BUILDING'""",
)
def _project_filter_sort(spark, sf_dir):
    wanted = (F.col("sal") > 1500) & (F.col("job") == "BUILDING")
    rows = parsing.project_filter_sort(employees(spark, sf_dir), ["ename", "sal"], wanted, [F.desc("sal"), F.col("ename")])
    # A place in the sorted output: rows of earlier partitions, and those before it in its own.
    path = new_path(spark, "sorted")
    rows.withColumn("mark", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.parquet(path).withColumn("part", F.shiftright("mark", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("part").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.col("start") + F.col("mark").bitwiseAND((1 << 33) - 1)
    return kept.join(starts, "part").select("ename", "sal", place.alias("place"))


@query(
    "tokenize_lowercase",
    r"""SELECT doc_id, len(w) AS n_words, array_to_string(w, ' ') AS joined
        FROM (SELECT doc_id, list_transform(regexp_split_to_array(regexp_replace(text, '\s+$', ''), '\s+'),
              lambda x: regexp_replace(lower(x), '[,.]', '', 'g')) AS w FROM documents)""",
)
def _tokenize_lowercase(spark, sf_dir):
    tokens = parsing.tokenize_lowercase(table(spark, sf_dir, "documents"), "text")
    return tokens.select("doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("joined"))


@query(
    "register_functions",
    with_ctes(CITIES, PRODUCTS)
    + """SELECT city_id || ':' || city_name AS label, CAST(NULL AS VARCHAR) AS product_type FROM cities
         UNION ALL SELECT split_part(product_name, ' ', 1),
         json_extract_string(extend_info, '$.product_type') FROM products WHERE trim(product_name) <> ''""",
)
def _register_functions(spark, sf_dir):
    """The functions called from SQL text."""
    register_functions(spark)
    cities(spark, sf_dir).createOrReplaceTempView("suite_cities")
    products(spark, sf_dir).createOrReplaceTempView("suite_products")
    return spark.sql(
        """SELECT concat_int_string(city_id, city_name) AS label, CAST(NULL AS STRING) AS product_type
           FROM suite_cities
           UNION ALL
           SELECT first_segment(product_name, ' '), get_string_from_json(extend_info, 'product_type')
           FROM suite_products WHERE isNotEmpty(product_name)"""
    )
