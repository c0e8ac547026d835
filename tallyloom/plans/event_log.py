"""Event log lines to cells, and new users out of the cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import server_time_to_millis
from tallyloom.functions.text import event_row_key, is_blank
from tallyloom.operators.aggregates import LAUNCH, new_users_both
from tallyloom.operators.enrich import enrich_region, enrich_user_agent
from tallyloom.operators.parsing import filter_event_types, parse_event_log
from tallyloom.sinks.cells import clustered_cells, daily_table, map_to_cells
from tallyloom.sources.catalog import read_clustered_cells, read_wide_column

TABLE = "event_logs"
FAMILY = "info"
NEW_USER_COLUMNS = ["en", "u_ud", "s_time", "ver", "pl", "browser", "browser_v"]
_DERIVED = ["country", "province", "city", "browser", "browser_v", "os", "os_v"]


def clean_events(lines: DataFrame, ranges: DataFrame | None = None, col: str = "value") -> DataFrame:
    """Known events with their row key and one map of all fields, derived ones included."""
    # The address of the line itself; a query field may have the same name.
    lines = lines.withColumn("_ip", F.substring_index(col, "^A", 1))
    events = parse_event_log(lines, col, keep=["_ip"]).withColumn("en", F.col("fields")["en"])
    events = filter_event_types(events)
    events = enrich_user_agent(events.withColumn("_ua", F.col("fields")["b_iev"]), "_ua")
    derived = _DERIVED[3:]
    if ranges is not None:
        events = enrich_region(events, "_ip", ranges)
        # A line without an address has no region.
        events = events.withColumns({c: F.when(~is_blank(F.col("_ip")), F.col(c)) for c in _DERIVED[:3]})
        derived = _DERIVED
    plain = F.map_filter("fields", lambda k, v: ~k.isin(derived))
    added = F.map_from_arrays(
        F.array(*[F.lit(c) for c in derived]),
        F.array(*[F.coalesce(F.col(c), F.col("fields")[c]) for c in derived]),
    )
    key = event_row_key(
        server_time_to_millis(F.col("fields")["s_time"]),
        F.col("fields")["u_ud"],
        F.col("fields")["u_mid"],
        F.col("en"),
    )
    return events.select(key.alias("row_key"), "en", F.map_concat(plain, added).alias("fields"))


def load_events(lines: DataFrame, root: str, date: str, ranges: DataFrame | None = None) -> str:
    """Write the cells of one day below ``root``, in place of an earlier run; returns the path."""
    path = f"{root.rstrip('/')}/{daily_table(TABLE, date)}"
    cells = map_to_cells(clean_events(lines, ranges), "row_key", "fields", FAMILY)
    cells.write.mode("overwrite").partitionBy("family").parquet(path)
    return path


def load_event_cells(
    lines: DataFrame, name: str, path: str | None = None, ranges: DataFrame | None = None, buckets: int = 64
) -> None:
    """Write the cells of one day as a catalog table, clustered by row key; ``name`` and ``path`` are those of the day."""
    clustered_cells(map_to_cells(clean_events(lines, ranges), "row_key", "fields", FAMILY), name, path, buckets)


def new_users_of_cells(spark: SparkSession, name: str) -> DataFrame:
    """New users of a day that ``load_event_cells`` wrote; only launch events are put together."""
    return new_users_both(read_clustered_cells(spark, name, FAMILY, NEW_USER_COLUMNS, ("en", LAUNCH)))


def new_users(spark: SparkSession, path: str) -> DataFrame:
    """New users of a loaded day by platform, and by platform and browser."""
    return new_users_both(read_wide_column(spark, path, FAMILY, NEW_USER_COLUMNS))
