"""Sliding windows over event time.

Each function takes a static or a streaming DataFrame.  A streaming one gets
a watermark, so that Spark can drop the state of windows that are over: rows
that come later than ``lateness`` behind the newest one are not counted.
Window starts are multiples of the slide, counted from the epoch.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import words
from tallyloom.operators.joins import whitelist_exclusion
from tallyloom.operators.topn import first_n

LATENESS = "10 minutes"
BOUND_PATTERN = "yyyy/MM/dd HH:mm:ss"
# Interval units in milliseconds.
_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}
_PART = re.compile(r"\s*(\d+)\s*([a-z]+?)s?(?=[\s\d]|$)")


def milliseconds(duration: str) -> int:
    """``20 seconds``, ``1 week``, ``INTERVAL 1 minute 30 seconds`` … as a number."""
    text = duration.strip().lower().removeprefix("interval").replace("'", " ")
    parts, end = [], 0
    for found in _PART.finditer(text):
        if found.start() != end or found[2] not in _UNITS:
            break
        parts.append(int(found[1]) * _UNITS[found[2]])
        end = found.end()
    if not parts or text[end:].strip():
        raise ValueError(f"not an interval of weeks to milliseconds: {duration!r}")
    return sum(parts)


def seconds(duration: str) -> float:
    """An interval in seconds; a whole number if it is one."""
    whole, rest = divmod(milliseconds(duration), 1000)
    return whole + rest / 1000 if rest else whole


def watermarked(df: DataFrame, ts: str, lateness: str = LATENESS) -> DataFrame:
    return df.withWatermark(ts, lateness) if df.isStreaming else df


def _flat(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


def window_counts(
    df: DataFrame,
    ts: str,
    keys: list[str],
    size: str,
    slide: str,
    lateness: str = LATENESS,
    by_pane: bool = False,
) -> DataFrame:
    """Rows for each window and key, as ``cnt``.

    A row lies in size / slide windows.  ``by_pane`` counts a static input
    first in panes that no window border cuts, and then adds up panes: with
    few keys the rows are multiplied only after they have become counts.
    """
    source = watermarked(df.select(ts, *keys), ts, lateness)
    if not by_pane or df.isStreaming:
        counted = source.groupBy(F.window(ts, size, slide), *keys).agg(F.count(F.lit(1)).alias("cnt"))
        return _flat(counted, *keys, "cnt")
    pane = f"{math.gcd(milliseconds(size), milliseconds(slide))} milliseconds"
    panes = (
        source.groupBy(F.window(ts, pane).alias("pane"), *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col("pane.start").alias("_start"), *keys, "_n")
    )
    counted = panes.groupBy(F.window("_start", size, slide), *keys).agg(F.sum("_n").alias("cnt"))
    return _flat(counted, *keys, "cnt")


def window_word_count(
    df: DataFrame,
    ts: str = "ts",
    size: str = "9 seconds",
    slide: str = "6 seconds",
    col: str = "value",
    lateness: str = LATENESS,
) -> DataFrame:
    """Words for each sliding window."""
    return window_counts(words(df, col, drop_blank=True, keep=[ts]), ts, ["word"], size, slide, lateness)


def window_word_count_incremental(
    df: DataFrame,
    ts: str = "ts",
    size: str = "9 seconds",
    slide: str = "6 seconds",
    col: str = "value",
    lateness: str = LATENESS,
) -> DataFrame:
    """The same result; Spark keeps one count for each open window and adds to it.

    Nothing is taken back when a window moves on, and a word that has left
    the window has no row with 0.
    """
    return window_word_count(df, ts, size, slide, col, lateness)


def window_order_count(
    df: DataFrame,
    ts: str = "ts",
    size: str = "20 seconds",
    slide: str = "10 seconds",
    province: str = "province_id",
    lateness: str = LATENESS,
) -> DataFrame:
    """Orders of each province for each sliding window."""
    return window_counts(df, ts, [province], size, slide, lateness, by_pane=True)


def top_of_windows(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The largest counts of each window; for static input, as in ``foreachBatch``."""
    order: list[Column] = [F.desc("cnt"), F.asc(key)]
    return first_n(counts, ["window_start", "window_end"], order, n)


def window_top5_provinces(
    df: DataFrame,
    ts: str = "ts",
    size: str = "20 seconds",
    slide: str = "8 seconds",
    n: int = 5,
    province: str = "province_id",
    lateness: str = LATENESS,
) -> DataFrame:
    """The provinces with most orders in each window."""
    return top_of_windows(window_order_count(df, ts, size, slide, province, lateness), province, n)


def window_top_stream(
    df: DataFrame,
    ts: str = "ts",
    size: str = "20 seconds",
    slide: str = "8 seconds",
    n: int = 5,
    province: str = "province_id",
    lateness: str = LATENESS,
) -> DataFrame:
    """The same of a stream, each window once, when the watermark has passed it.  Run it in ``append`` mode.

    Two stateful aggregations in a row: counts by window and province, and then the counts of a window that is over.
    The second sees one row for each province and window, never the rows themselves; its windows are as long as the
    slide and end where those of the first end, so each holds exactly one of them.
    """
    counted = watermarked(df.select(ts, province), ts, lateness).groupBy(F.window(ts, size, slide), province).agg(F.count(F.lit(1)).alias("cnt"))
    step, offset = milliseconds(slide), milliseconds(size) % milliseconds(slide)
    closing = F.window(F.window_time("window"), f"{step} milliseconds", f"{step} milliseconds", f"{offset} milliseconds")
    entry = F.struct((-F.col("cnt")).alias("less"), F.col(province).alias("who"), F.col("window").alias("span"))
    first = F.slice(F.sort_array(F.collect_list(entry)), 1, n)
    ranked = counted.groupBy(closing.alias("closing")).agg(first.alias("first")).select(F.posexplode("first").alias("place", "e"))
    return ranked.select(
        F.col("e.span.start").alias("window_start"),
        F.col("e.span.end").alias("window_end"),
        F.col("e.who").alias(province),
        (-F.col("e.less")).alias("cnt"),
        (F.col("place") + 1).alias("rank"),
    )


def dynamic_blacklist(
    df: DataFrame,
    white: DataFrame,
    size: str = "60 seconds",
    slide: str = "18 seconds",
    threshold: int = 100,
    ts: str = "ts",
    user: str = "user_id",
    inclusive: bool = False,
    lateness: str = LATENESS,
) -> DataFrame:
    """Users with more than ``threshold`` clicks in some window, without the white list.

    ``inclusive`` takes the threshold itself too.  On a stream the result
    holds a user once for each window; the set sink keeps one.
    """
    counts = window_counts(df, ts, [user], size, slide, lateness)
    cnt = F.col("cnt")
    hot = counts.filter(cnt >= threshold if inclusive else cnt > threshold).select(user)
    hot = hot if df.isStreaming else hot.distinct()
    return whitelist_exclusion(hot, white, user)


def ad_click_window(
    df: DataFrame,
    size: str = "60 seconds",
    slide: str = "6 seconds",
    ts: str = "ts",
    ad: str = "ad_id",
    pattern: str = BOUND_PATTERN,
    lateness: str = LATENESS,
) -> DataFrame:
    """Clicks of each ad for each sliding window, with the borders as text."""
    counts = window_counts(df, ts, [ad], size, slide, lateness, by_pane=True)
    return counts.select(
        F.date_format("window_start", pattern).alias("window_start"),
        F.date_format("window_end", pattern).alias("window_end"),
        ad,
        F.col("cnt").alias("click_count"),
    )


def ad_click_window_packed(
    df: DataFrame, size: str = "60 seconds", slide: str = "6 seconds", ts: str = "ts", ad: str = "ad_id"
) -> DataFrame:
    """The same as key and value: ``start:end,ad`` and the count."""
    window = F.concat_ws(":", "window_start", "window_end")
    return ad_click_window(df, size, slide, ts, ad).select(
        F.concat_ws(",", window, F.col(ad).cast("string")).alias("key"),
        F.col("click_count").cast("string").alias("value"),
    )
