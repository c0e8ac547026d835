"""Inputs of the queries, made from the given tables by plain expressions.

Every function has an SQL twin of the same name in capitals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.parsing import ACCESS_LOG_PATTERN
from tallyloom.shared_folder import new_path

AREA_LEVELS = {"AFRICA": "A", "AMERICA": "B", "ASIA": "C", "EUROPE": "D"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Batches that a table is streamed in: five at least, and more if a batch would have more rows than this.
BATCHES, BATCH_ROWS = 5, 1_000_000
_TIMES = {"events": "ts", "orders": "o_orderdate"}


def stream(spark: SparkSession, sf_dir: str, name: str, newest_first: bool = False) -> DataFrame:
    """A given table as a stream of several batches in order of time, all rows included.

    One pass deals the rows to spans of time, each a file of a new folder that one task writes; each batch takes one file.
    Files are taken in the order of their times, which are set to that of the spans; with ``newest_first`` the spans
    arrive backwards, so that all rows but those of the first batch are late.
    """
    rows, time = table(spark, sf_dir, name), _TIMES[name]
    inbox, at = new_path(spark, f"{name}-inbox"), F.unix_micros(F.col(time).cast("timestamp"))
    lo, hi, n = rows.agg(F.min(at), F.max(at), F.count("*")).first()
    batches = max(BATCHES, -(-n // BATCH_ROWS)) if lo is not None else 1
    share = (at - F.lit(lo)).cast("double") / F.lit(1 + (hi or 0) - (lo or 0))
    span = F.coalesce(F.floor(share * batches), F.lit(0)).cast("int").alias("_span")
    rows.select("*", span).repartition(batches, "_span").write.partitionBy("_span").parquet(inbox)
    _in_order(spark, inbox, range(batches), newest_first)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox).drop("_span")


def _in_order(spark: SparkSession, inbox: str, spans: range, newest_first: bool) -> None:
    """Give the files of each span the time that its place in the order asks for."""
    jvm = spark._jvm
    for span in spans:
        folder = jvm.org.apache.hadoop.fs.Path(f"{inbox}/_span={span}")
        fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if fs.exists(folder):
            place = len(spans) - span if newest_first else span + 1
            for found in fs.listStatus(folder):
                fs.setTimes(found.getPath(), 1_000_000_000_000 + 1000 * place, -1)


def with_instant(df: DataFrame, ts: str = "ts") -> DataFrame:
    """A column without a zone as an instant: watermarks need one."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


# --- product visits -------------------------------------------------------------------------


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of products; those that are no click have an empty product."""
    items = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_part"),
        F.when(F.col("l_returnflag") == "R", "")
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("click_product_id"),
        "l_suppkey",
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("city_id")
    )
    return items.join(suppliers, "l_suppkey").drop("l_suppkey")


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (F.col("p_size") % 2).cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_type":"'), kind, F.lit('"}')).alias("extend_info"),
    )


VISITS = """
visits AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_part,
         CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS click_product_id,
         s_nationkey AS city_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
CITIES = """
cities AS (
  SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         '{"product_type":"' || CAST(p_size % 2 AS VARCHAR) || '"}' AS extend_info
  FROM part)"""


# --- ad clicks ------------------------------------------------------------------------------


def ad_click_columns(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("province_"), user % 34).alias("province"),
        F.concat(F.lit("city_"), user % 100).alias("city"),
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("ad_id"),
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_click_columns(table(spark, sf_dir, "events"))


def ad_click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_instant(ad_click_columns(stream(spark, sf_dir, "events")))


AD_CLICKS = r"""
ad_clicks AS (
  SELECT event_id, ts, 'province_' || CAST(user_id % 34 AS VARCHAR) AS province,
         'city_' || CAST(user_id % 100 AS VARCHAR) AS city, user_id,
         CAST(regexp_extract(props, '"k": *(\d+)', 1) AS BIGINT) AS ad_id
  FROM events)"""
AD_STATE = """
state AS (
  SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, count(*) AS click_count
  FROM ad_clicks GROUP BY ALL)"""

# --- orders ---------------------------------------------------------------------------------

_ORDER_TYPES = {"1-URGENT": "alipay", "2-HIGH": "weixin", "3-MEDIUM": "card", "5-LOW": "cash"}


def order_columns(order_rows: DataFrame, customers: DataFrame) -> DataFrame:
    kind = None
    for priority, name in _ORDER_TYPES.items():
        kind = (F if kind is None else kind).when(F.col("o_orderpriority") == priority, name)
    places = customers.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("province_id")
    )
    return order_rows.join(places, "o_custkey").select(
        F.col("o_orderdate").alias("ts"),
        kind.alias("order_type"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        "province_id",
        F.col("o_totalprice").alias("order_price"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_columns(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_columns(stream(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    return with_instant(rows)


ORDERS = """
order_rows AS (
  SELECT o_orderdate AS ts,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' WHEN '2-HIGH' THEN 'weixin'
              WHEN '3-MEDIUM' THEN 'card' WHEN '5-LOW' THEN 'cash' END AS order_type,
         CAST(o_orderkey AS VARCHAR) AS order_id, c_nationkey AS province_id,
         o_totalprice AS order_price
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

# --- log lines ------------------------------------------------------------------------------


def _ip(user) -> F.Column:
    return F.concat(
        F.lit("10.0."), F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string")
    )


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server log lines; every eleventh has no size."""
    size = F.when(F.col("event_id") % 11 == 0, "-").otherwise(
        F.floor("value").cast("bigint").cast("string")
    )
    status = F.when(F.col("event_type") == "error", "500").otherwise("200")
    return table(spark, sf_dir, "events").select(
        F.concat(
            _ip(F.col("user_id")),
            F.lit(" - - ["),
            F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
            F.lit(' +0000] "GET /'),
            "event_type",
            F.lit("/"),
            F.get_json_object("props", "$.k"),
            F.lit(' HTTP/1.1" '),
            status,
            F.lit(" "),
            size,
        ).alias("value")
    )


ACCESS_LINES = r"""
access_lines AS (
  SELECT '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)
         || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /' || event_type || '/'
         || regexp_extract(props, '"k": *(\d+)', 1) || ' HTTP/1.1" '
         || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ' '
         || CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
         AS value
  FROM events),
matched AS (
  SELECT value, regexp_extract_all(value,
    '""" + ACCESS_LOG_PATTERN + r"""', 0) AS m
  FROM access_lines),
access_log AS (
  SELECT p[1] AS ip_address, p[2] AS client_ident, p[3] AS user_id, p[4] AS date_time,
         p[5] AS method, p[6] AS endpoint, p[7] AS protocol,
         CAST(p[8] AS INTEGER) AS response_code, CAST(p[9] AS BIGINT) AS content_size
  FROM (
    SELECT [regexp_extract(value, r, 1), regexp_extract(value, r, 2), regexp_extract(value, r, 3),
            regexp_extract(value, r, 4), regexp_extract(value, r, 5), regexp_extract(value, r, 6),
            regexp_extract(value, r, 7), regexp_extract(value, r, 8), regexp_extract(value, r, 9)] AS p
    FROM (SELECT value,
      '""" + ACCESS_LOG_PATTERN + r"""' AS r
      FROM matched WHERE len(m) > 0)))"""

_AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 Chrome/46.0.2490.71 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64) Gecko/20100101 Firefox/115.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15) Version/17.1 Safari/605.1",
)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log lines; the error events have an unknown name, views have no platform."""
    user, k = F.col("user_id"), F.get_json_object("props", "$.k")
    name = (
        F.when(F.col("event_type") == "signup", "e_l")
        .when(F.col("event_type") == "view", "e_pv")
        .when(F.col("event_type") == "purchase", "e_crt")
        .when(F.col("event_type") == "click", "e_e")
        .otherwise("e_x")
    )
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    secs = F.concat(
        F.floor(millis / 1000).cast("string"), F.lit("."), F.lpad((millis % 1000).cast("string"), 3, "0")
    )
    agent = (
        F.when(user % 4 == 0, _AGENTS[0])
        .when(user % 4 == 1, _AGENTS[1])
        .when(user % 4 == 2, _AGENTS[2])
        .otherwise("curl")
    )
    platform = F.when(F.col("event_type") == "view", "").otherwise(F.lit("&pl=website"))
    version = F.when(user % 3 == 0, "").otherwise(F.concat(F.lit("&ver="), (user % 3).cast("string")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(
            _ip(user),
            F.lit("^A"),
            secs,
            F.lit("^Ashop.example.com^A/log.gif?en="),
            name,
            F.lit("&u_ud=u"),
            user.cast("string"),
            F.lit("&u_mid=m%20"),
            k,
            platform,
            version,
            F.lit("&b_iev="),
            F.url_encode(agent),
        ).alias("value"),
    )


EVENT_LINES = r"""
event_lines AS (
  SELECT event_id, '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
         CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.' || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS s_time,
         'shop.example.com' AS http_host,
         CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'purchase' THEN 'e_crt'
              WHEN 'click' THEN 'e_e' ELSE 'e_x' END AS en,
         'u' || CAST(user_id AS VARCHAR) AS u_ud,
         'm ' || regexp_extract(props, '"k": *(\d+)', 1) AS u_mid,
         CASE WHEN event_type = 'view' THEN NULL ELSE 'website' END AS pl,
         CASE WHEN user_id % 3 = 0 THEN NULL ELSE CAST(user_id % 3 AS VARCHAR) END AS ver,
         CASE user_id % 4 WHEN 0 THEN '""" + _AGENTS[0] + "' WHEN 1 THEN '" + _AGENTS[1] + r"""'
              WHEN 2 THEN '""" + _AGENTS[2] + r"""' ELSE 'curl' END AS b_iev,
         CASE user_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' END AS browser,
         CASE user_id % 4 WHEN 0 THEN '46.0.2490.71' WHEN 1 THEN '115.0' WHEN 2 THEN '17.1' END AS browser_v,
         CASE user_id % 4 WHEN 0 THEN 'Windows' WHEN 1 THEN 'Windows' WHEN 2 THEN 'OS X' END AS os,
         CASE user_id % 4 WHEN 0 THEN 'Windows 7' WHEN 1 THEN 'Windows 10' WHEN 2 THEN 'OS X' END AS os_v
  FROM events)"""

# --- ratings, employees ---------------------------------------------------------------------


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("int").alias("user_id")
    )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("int").alias("item_id"), F.col("l_quantity").alias("rating")
    )
    return items.join(bought, "l_orderkey").drop("l_orderkey")


RATINGS = """
ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id, l_quantity AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("empno"),
        F.col("c_name").alias("ename"),
        F.col("c_mktsegment").alias("job"),
        F.col("c_acctbal").alias("sal"),
        F.col("c_nationkey").alias("deptno"),
    )


EMPLOYEES = """
employees AS (
  SELECT c_custkey AS empno, c_name AS ename, c_mktsegment AS job, c_acctbal AS sal, c_nationkey AS deptno
  FROM customer)"""


def address_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address ranges made from nations: 64 addresses each, named after nation and region."""
    first = F.lit(10 * 256**3).cast("bigint") + F.col("city_id") * 64
    return cities(spark, sf_dir).select(
        first.alias("lo"),
        (first + 63).alias("hi"),
        F.concat("area", F.lit("省"), "city_name", F.lit("市")).alias("area"),
    )


ADDRESS_RANGES = CITIES + """,
ranges AS (
  SELECT 167772160 + city_id * 64 AS lo, 167772160 + city_id * 64 + 63 AS hi,
         area AS province, city_name AS city
  FROM cities)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)
