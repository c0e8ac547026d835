"""The ad-click stream: blacklist, running clicks, provincial ranking, recent clicks.

Every ``start_`` function takes a ``generation``: 0 at first, and a higher one each time a query starts with a new
checkpoint while its stores stay.  The stores refuse a generation that is over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.topn import province_top5_ads
from tallyloom.sinks.stores import changed_rows, count_sink, largest, read_counts, read_replaced, read_upserted, replace_sink, upsert_sink
from tallyloom.streaming.blacklist import blacklist_sink, filtered_batches
from tallyloom.streaming.runner import resume_from_checkpoint
from tallyloom.streaming.state import STATE_KEYS, ad_click_periods, click_dimensions
from tallyloom.streaming.windows import LATENESS, ad_click_window, seconds, window_counts

BLACKLIST_WINDOW = ("60 seconds", "18 seconds")
RECENT_WINDOW = ("60 seconds", "6 seconds")
RANK_KEYS = ["date", "province", "rank"]
PERIOD_KEYS = [*STATE_KEYS, "period_start"]
_AD_KEYS = ["date", "province", "ad_id"]


def start_blacklist(
    clicks: DataFrame,
    white: DataFrame,
    root: str,
    checkpoint: str,
    threshold: int = 100,
    window: tuple[str, str] = BLACKLIST_WINDOW,
    every: str | None = None,
    lateness: str = LATENESS,
    generation: int = 0,
) -> StreamingQuery:
    """The query that puts users with too many clicks in a window on the list."""
    counts = window_counts(clicks, "ts", ["user_id"], *window, lateness)
    sink = blacklist_sink(f"{root}/blacklist", white, threshold=threshold, generation=generation)
    return resume_from_checkpoint(counts, sink, f"{checkpoint}/blacklist", every=every)


def start_click_counts(
    clicks: DataFrame, root: str, checkpoint: str, every: str | None = None, generation: int = 0
) -> StreamingQuery:
    """The query that counts the clicks of users that are not listed.

    The list is read for every batch, and a batch that the store has already is left out, so running a batch again
    changes nothing.
    """
    count = count_sink(f"{root}/state", list(STATE_KEYS), generation=generation)
    sink = filtered_batches(f"{root}/blacklist", lambda batch, n: count(click_dimensions(batch), n))
    return resume_from_checkpoint(clicks, sink, f"{checkpoint}/state", mode="append", every=every)


def click_state(spark: SparkSession, root: str) -> DataFrame:
    """Clicks so far by date, province, city and ad."""
    return read_counts(spark, f"{root}/state", list(STATE_KEYS))


def province_ranking(spark: SparkSession, root: str, n: int = 5) -> DataFrame:
    """The ads with most clicks so far for each date and province."""
    return province_top5_ads(click_state(spark, root), n)


def start_recent_clicks(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    window: tuple[str, str] = RECENT_WINDOW,
    every: str | None = None,
    lateness: str = LATENESS,
    generation: int = 0,
) -> StreamingQuery:
    """The query that keeps the clicks of each ad in the newest window that is over.

    A window is over when the watermark has passed it.  Its rows take the place of those of the window before in one
    step; a batch in which no window ends leaves the target alone.
    """
    replace = replace_sink(f"{root}/recent", generation)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # taken twice: for the newest window and for its rows
        try:
            newest = batch.agg(F.max("window_start")).first()[0]
            if newest is not None:
                replace(batch.where(F.col("window_start") == newest), batch_id)
        finally:
            batch.unpersist()

    counts = ad_click_window(clicks, *window, lateness=lateness)
    return resume_from_checkpoint(counts, publish, f"{checkpoint}/recent", mode="append", every=every)


def recent_clicks(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The clicks of each ad in the window that was published last; none before the first."""
    schema = "window_start STRING, window_end STRING, ad_id BIGINT, click_count BIGINT"
    return read_replaced(spark, f"{root}/recent", schema, version)


def start_province_top5(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    n: int = 5,
    idle: str = "1 day",
    every: str | None = None,
    generation: int = 0,
) -> StreamingQuery:
    """The query that keeps, for each date and province, the ads with most clicks, one row a rank.

    An ad without a click for longer than ``idle``, counted back from the newest click, leaves the ranking; its count
    goes on if it comes back.  A rank that has no ad any more is deleted.  A batch writes the ranks that changed.  The
    clicks of a date lie within it, so only dates that ``idle`` reaches back to are read from the counts.
    """
    count = count_sink(f"{root}/ranked", _AD_KEYS, generation=generation, newest="last")
    put = upsert_sink(f"{root}/top5", RANK_KEYS, generation)

    def rank(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        count(_dated(batch), batch_id)
        newest = largest(spark, f"{root}/ranked", "last")
        if newest is None:
            return
        counts = read_counts(spark, f"{root}/ranked", _AD_KEYS, newest="last")
        since = F.lit(newest) - F.make_interval(secs=F.lit(seconds(idle)))
        live = counts.where((F.col("date") >= F.date_format(since, "yyyyMMdd")) & (F.col("last") >= since))
        wanted = province_top5_ads(live.drop("last"), n).select(*RANK_KEYS, "ad_id", "click_count")
        put(changed_rows(province_top5(spark, root), wanted, RANK_KEYS), batch_id)

    return resume_from_checkpoint(clicks, rank, f"{checkpoint}/top5", mode="append", every=every)


def start_click_periods(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    idle: str = "36 seconds",
    every: str | None = None,
    lateness: str = LATENESS,
    generation: int = 0,
) -> StreamingQuery:
    """The query that keeps the running count of each period of a key, from its first click on."""
    conf, name = clicks.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        counts = ad_click_periods(clicks, idle, lateness=lateness)
        sink = upsert_sink(f"{root}/periods", PERIOD_KEYS, generation)
        return resume_from_checkpoint(counts, sink, f"{checkpoint}/periods", every=every)
    finally:  # a query keeps the settings that it was started with
        conf.unset(name) if before is None else conf.set(name, before)


def click_periods(spark: SparkSession, root: str) -> DataFrame:
    """The periods so far with their counts; those that are not over yet too."""
    return read_upserted(spark, f"{root}/periods", PERIOD_KEYS)


def _dated(clicks: DataFrame) -> DataFrame:
    return clicks.select(F.date_format("ts", "yyyyMMdd").alias("date"), "province", "ad_id", F.col("ts").alias("last"))


def province_top5(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The ranks that have an ad."""
    schema = "date STRING, province STRING, rank INT, ad_id BIGINT, click_count BIGINT"
    return read_upserted(spark, f"{root}/top5", RANK_KEYS, schema, version)
