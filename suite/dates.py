"""Date and time functions over the given dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.tables import table
from tallyloom.functions import dates


def _millis():
    return F.unix_millis(F.col("ts").cast("timestamp"))


@query(
    "millis_to_string",
    """SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y/%m/%d %H:%M:%S') AS at,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000) - INTERVAL 60 SECOND, '%Y/%m/%d %H:%M:%S') AS earlier
       FROM events""",
)
def _millis_to_string(spark, sf_dir):
    pattern = "yyyy/MM/dd HH:mm:ss"
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.millis_to_string(_millis(), pattern).alias("at"),
        dates.millis_to_string(_millis(), pattern, "-60 seconds").alias("earlier"),
    )


@query(
    "server_time_to_millis",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN -1
       ELSE CAST(trunc(CAST(value AS DOUBLE) * 1000) AS BIGINT) END AS ms FROM events""",
)
def _server_time_to_millis(spark, sf_dir):
    """Event values as texts of seconds; errors become texts that are no number."""
    seconds = F.when(F.col("event_type") == "error", "x").otherwise(F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", dates.server_time_to_millis(seconds).alias("ms"))


@query(
    "is_valid_running_date",
    """SELECT o_orderkey, o_orderpriority <> '1-URGENT' AS valid FROM orders""",
)
def _is_valid_running_date(spark, sf_dir):
    pattern = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy/MM/dd"))
    day = pattern.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.is_valid_running_date(day).alias("valid"))


@query("parse_date_string", "SELECT o_orderkey, epoch_ms(date_trunc('day', o_orderdate)) AS ms FROM orders")
def _parse_date_string(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date_string(day).alias("ms"))


@query("format_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _format_date(spark, sf_dir):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.format_date(ms).alias("day"))


@query(
    "date_part_of",
    """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS season,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(hour(d) AS INTEGER) AS hour,
       CAST(date_diff('day', first_sunday, date_trunc('day', d) - to_days(CAST(dayofweek(d) AS INTEGER))) // 7 + 1
            AS INTEGER) AS week
       FROM (SELECT *, y1 - to_days(CAST(dayofweek(y1) AS INTEGER)) AS first_sunday
         FROM (SELECT o_orderkey, o_orderdate AS d,
           CAST(date_trunc('year', date_trunc('day', o_orderdate)
             + to_days(6 - CAST(dayofweek(o_orderdate) AS INTEGER))) AS TIMESTAMP) AS y1 FROM orders))""",
)
def _date_part_of(spark, sf_dir):
    parts = ["year", "season", "month", "week", "day", "hour"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[dates.date_part_of(F.col("o_orderdate"), p).alias(p) for p in parts]
    )


@query(
    "period_starts",
    """SELECT o_orderkey, d AS today, sunday AS this_week, sunday - 7 AS previous_week, sunday + 7 AS next_week,
       CAST(date_trunc('month', d) AS DATE) AS this_month,
       CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS previous_month,
       CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS next_month, d - 3 AS three_days_ago
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
             CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS sunday FROM orders)""",
)
def _period_starts(spark, sf_dir):
    day = F.col("o_orderdate")
    periods = ["today", "this_week", "previous_week", "next_week", "this_month", "previous_month", "next_month"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[dates.period_starts(day, p).alias(p) for p in periods],
        dates.period_starts(day, "today", -3).alias("three_days_ago"),
    )


@query(
    "yesterday",
    """SELECT o_orderkey, strftime(current_date - CAST(o_orderkey % 3 AS INTEGER), '%Y-%m-%d') < strftime(current_date - 1, '%Y-%m-%d') AS older
       FROM orders""",
)
def _yesterday(spark, sf_dir):
    """Days around yesterday, told apart by the key of an order."""
    day = F.date_sub(F.current_date(), (F.col("o_orderkey") % 3).cast("int"))
    older = F.date_format(day, "yyyy-MM-dd") < dates.yesterday()
    return table(spark, sf_dir, "orders").select("o_orderkey", older.alias("older"))
