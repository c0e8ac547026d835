"""The order stream: totals by province, recent orders, and the leading provinces of each window.

Every ``start_`` function takes a ``generation``: 0 at first, and a higher one each time a query starts with a new
checkpoint while its stores stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.sinks.stores import append_sink, read_upserted, total_sink, upsert_sink
from tallyloom.streaming.runner import resume_from_checkpoint
from tallyloom.streaming.state import order_total_by_province
from tallyloom.streaming.windows import LATENESS, top_of_windows, window_order_count, window_top_stream

WINDOW_KEYS = ["window_start", "window_end", "province_id"]


def start_totals(orders: DataFrame, path: str, checkpoint: str, every: str | None = None, generation: int = 0) -> StreamingQuery:
    """Running total of each province, kept as latest value by key.

    With a new checkpoint, and a higher ``generation``, totals go on from those in the store.
    """
    sink = total_sink(path, ["province_id"], "total", generation)
    return resume_from_checkpoint(order_total_by_province(orders), sink, checkpoint, every=every)


def start_window_counts(
    orders: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "20 seconds",
    slide: str = "8 seconds",
    every: str | None = None,
    lateness: str = LATENESS,
    generation: int = 0,
) -> StreamingQuery:
    """Orders of each province in each window, kept as latest value by window and province."""
    counts = window_order_count(orders, "ts", size, slide, lateness=lateness)
    return resume_from_checkpoint(counts, upsert_sink(path, WINDOW_KEYS, generation), checkpoint, every=every)


def latest_window_top(spark, path: str, n: int = 5) -> DataFrame:
    """The provinces with most orders in the newest window that has been written."""
    counts = read_upserted(spark, path, WINDOW_KEYS)
    newest = counts.agg(F.max("window_start").alias("window_start"))
    return top_of_windows(counts.join(newest, "window_start", "left_semi"), "province_id", n)


def start_window_top(
    orders: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "20 seconds",
    slide: str = "8 seconds",
    n: int = 5,
    every: str | None = None,
    lateness: str = LATENESS,
    generation: int = 0,
) -> StreamingQuery:
    """The provinces with most orders of every window that is over; a window is written once."""
    top = window_top_stream(orders, "ts", size, slide, n, lateness=lateness)
    return resume_from_checkpoint(top, append_sink(path, generation), checkpoint, mode="append", every=every)
