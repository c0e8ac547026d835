"""Running totals.  Each function takes a static or a streaming DataFrame.

Run streams in ``update`` mode: a batch then gives the keys it touched,
with their new totals.  Spark adds up the rows of a batch by key in every
task before the state is read.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import exact, word_count
from tallyloom.streaming.windows import milliseconds, seconds

if TYPE_CHECKING:
    import pandas as pd

DAY_PATTERN = "yyyyMMdd"
STATE_KEYS = ("date", "province", "city", "ad_id")


def stream_word_count(df: DataFrame, col: str = "value") -> DataFrame:
    """Words of one batch; use it in ``foreachBatch`` to count each batch on its own."""
    return word_count(df, col, drop_blank=True)


def order_total_by_province(
    df: DataFrame, province: str = "province_id", price: str = "order_price"
) -> DataFrame:
    """Total price of each province since the start."""
    return df.groupBy(province).agg(F.sum(exact(F.col(price))).cast("double").alias("total"))


def order_total_mapped_state(
    df: DataFrame, province: str = "province_id", price: str = "order_price"
) -> DataFrame:
    """The same totals; ``update`` mode already gives only the touched provinces."""
    return order_total_by_province(df, province, price)


def click_dimensions(df: DataFrame, ts: str = "ts", pattern: str = DAY_PATTERN) -> DataFrame:
    """The columns that clicks are counted by."""
    return df.select(F.date_format(ts, pattern).alias("date"), "province", "city", "ad_id")


def ad_click_state(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Clicks of each date, province, city and ad."""
    return click_dimensions(df, ts).groupBy(*STATE_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def ad_click_state_mapped(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Clicks by one text key ``date:province:ad``, the date as ``yyyy-MM-dd``."""
    dims = click_dimensions(df, ts, "yyyy-MM-dd")
    key: Column = F.concat_ws(":", "date", "province", F.col("ad_id").cast("string"))
    return (
        dims.groupBy("date", "province", "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(key.alias("state_key"), "click_count")
    )


def ad_click_state_expiring(
    df: DataFrame, idle: str = "36 seconds", ts: str = "ts", lateness: str = "10 minutes"
) -> DataFrame:
    """Clicks of a key until it has none for longer than ``idle``; then it starts again from 0.

    Such a period is a session window with ``idle`` as its gap.  On a stream,
    run it in ``append`` mode: a period comes out, and its state goes, once
    the watermark is past its end.

    A session needs all rows of a key in one task.  Static clicks are
    therefore counted first in panes of the length ``idle``, in which no
    period can end; a pane then counts as one click that lasts from its first
    to its last.  A hot key sends one row for each pane of its day.
    """
    day = F.date_format(ts, DAY_PATTERN).alias("date")
    if df.isStreaming:
        clicks = df.withWatermark(ts, lateness).select(ts, day, "province", "city", "ad_id")
        period, counted = F.session_window(ts, idle), F.count(F.lit(1))
    else:
        micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
        lasts = F.lit(seconds(idle)) + ((micros("_last") - micros("_first")) / 1_000_000).cast("decimal(18,6)")
        clicks = (
            df.groupBy(day, "province", "city", "ad_id", F.window(ts, idle))
            .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
            .withColumn("_lasts", F.make_interval(secs=lasts))
        )
        period, counted = F.session_window("_first", F.col("_lasts")), F.sum("_n")
    return (
        clicks.groupBy(period.alias("period"), *STATE_KEYS)
        .agg(counted.alias("click_count"))
        .select(
            *STATE_KEYS,
            F.col("period.start").alias("period_start"),
            F.col("period.end").alias("period_end"),
            "click_count",
        )
    )


def ad_click_state_expiring_updates(
    df: DataFrame, idle: str = "36 seconds", ts: str = "ts", lateness: str = "0 seconds"
) -> DataFrame:
    """The same periods, with a new running count for each batch that has clicks of a key.

    Spark gives session windows of a stream only when they are over.  Where
    the count has to be seen before, this function keeps it in a Python
    state, which costs far more for each key: prefer ``ad_click_state_expiring``
    where the end of a period is soon enough.

    A streaming DataFrame is needed; ``ts`` is a timestamp.  Each Arrow batch
    is reduced to one row for each key before the shuffle, so the state
    function of a hot key gets a few partial counts and not all its clicks.
    A key is dropped when the watermark passes its last click plus ``idle``;
    clicks that come after a longer gap start anew even if the watermark has
    not got there.  A gap between clicks of one Arrow batch is not seen; ``ad_click_periods`` sees it.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    idle_ms = milliseconds(idle)
    keys = list(STATE_KEYS)
    day = F.date_format(ts, DAY_PATTERN).alias("date")
    clicks = df.select(day, "province", "city", "ad_id", F.col(ts).alias("last_ts"), F.unix_millis(F.col(ts).cast("timestamp")).alias("last_ms"))
    ad_type = clicks.schema["ad_id"].dataType.simpleString()
    key_schema = f"date string, province string, city string, ad_id {ad_type}"

    def reduce(batches):
        for rows in batches:
            groups = rows.groupby(keys, sort=False, dropna=False)
            yield groups.agg(n=("last_ms", "size"), last_ts=("last_ts", "max"), first_ms=("last_ms", "min"), last_ms=("last_ms", "max")).reset_index()

    def advance(key, batches, state: GroupState):
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        count, last = state.get if state.exists else (0, 0)
        for rows in batches:
            rows = rows.sort_values("first_ms")
            for n, first, newest in zip(rows["n"], rows["first_ms"], rows["last_ms"], strict=True):  # pandas times are local ones
                count = int(n) + (count if int(first) <= last + idle_ms else 0)
                last = max(last, int(newest))
        state.update((count, last))
        state.setTimeoutTimestamp(max(last + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(*key, count)], columns=[*keys, "click_count"])

    return (
        clicks.mapInPandas(reduce, f"{key_schema}, n bigint, last_ts timestamp, first_ms bigint, last_ms bigint")
        .withWatermark("last_ts", lateness)
        .groupBy(*keys)
        .applyInPandasWithState(
            advance,
            outputStructType=f"{key_schema}, click_count bigint",
            stateStructType="clicks bigint, last_ms bigint",
            outputMode="update",
            timeoutConf=GroupStateTimeout.EventTimeTimeout,
        )
    )


def merged_periods(periods: pd.DataFrame, idle: int) -> pd.DataFrame:
    """``key``, ``first``, ``last`` and ``n`` of periods; those of a key that lie no further apart than ``idle`` become one.

    ``part`` numbers the merged periods in the order of key and start: it is there for each of the given ones, too.
    """
    periods = periods.sort_values(["key", "first"], kind="stable", ignore_index=True)
    reach = periods.groupby("key", sort=False)["last"].cummax()
    before = reach.groupby(periods["key"], sort=False).shift()
    return periods.assign(part=(~(periods["first"] <= before + idle)).cumsum())


def ad_click_periods(
    df: DataFrame, idle: str = "36 seconds", ts: str = "ts", lateness: str = "0 seconds", parts: int = 64
) -> DataFrame:
    """The same periods, each with its running count as soon as a batch has clicks of it.

    Spark gives session windows of a stream only when they are over.  Where the count has to be seen before, this
    function keeps the open periods in a Python state.  A call for each key would cost a millisecond or more, so keys
    are dealt to ``parts`` and a call merges all periods of a part at once; a part's open periods are one value of the
    state, about 100 bytes each.  Take more parts for batches of very many clicks; a checkpoint keeps to its number.

    ``df`` is a stream, ``ts`` a timestamp.  Clicks are reduced to periods within each Arrow batch, before the shuffle,
    so the state function of a hot key gets a few partial counts and not all its clicks; a gap is seen wherever it lies.
    Write the rows with ``upsert_sink`` by key and ``period_start``: a late click may join two periods, or move a start
    back, and then a row with ``_gone`` takes back the start that is no more.  A timer drops a period when the watermark
    has passed its end.  The state needs the RocksDB provider (``plans.ad_clicks.start_click_periods`` sets it).
    """
    from pyspark.sql.streaming import StatefulProcessor

    idle_us = 1000 * milliseconds(idle)
    keys, gone = list(STATE_KEYS), "_gone"
    day = F.date_format(ts, DAY_PATTERN).alias("date")
    micros = F.unix_micros(F.col(ts).cast("timestamp")).alias("last")
    named = df.select(day, "province", "city", "ad_id", F.col(ts).alias("last_ts"), micros)
    key_type = named.select(*keys).schema.simpleString()
    # Texts: Python would turn numbers into others where one is null.
    clicks = named.select(F.to_json(F.struct(*keys)).alias("key"), "last_ts", "last")

    def reduce(batches):
        for rows in batches:
            rows = rows.sort_values(["key", "last"], kind="stable")
            opens = ~(rows.groupby("key", sort=False)["last"].diff() <= idle_us)
            periods = rows.groupby(opens.cumsum(), sort=False)
            yield periods.agg(key=("key", "first"), last_ts=("last_ts", "max"), first=("last", "min"), last=("last", "max"), n=("last", "size"))

    class Periods(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getValueState("open", "periods binary")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            before = self._load()
            new = pd.concat([part[["key", "first", "last", "n"]] for part in rows])
            periods = merged_periods(pd.concat([before.assign(old=True), new.assign(old=False)]), idle_us)
            after = periods.groupby("part", sort=False).agg(key=("key", "first"), first=("first", "min"), last=("last", "max"), n=("n", "sum"), old=("old", "all"))
            self._keep(after, timerValues)
            start = after["first"].reindex(periods["part"]).to_numpy()
            lost = periods[periods["old"] & (periods["first"] != start)]
            out = pd.concat([after[~after["old"]].assign(**{gone: False}), lost.assign(**{gone: True})])
            yield out[["key", "first", "last", "n", gone]]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            before = self._load()
            self._keep(before[before["last"] + idle_us >= 1000 * timerValues.getCurrentWatermarkInMs()], timerValues)
            return iter(())

        def close(self) -> None:
            pass

        def _load(self):
            import pyarrow as pa

            if self.open.exists():
                return pa.ipc.open_stream(self.open.get()[0]).read_pandas()
            return pa.table({c: pa.array([], pa.string() if c == "key" else pa.int64()) for c in ("key", "first", "last", "n")}).to_pandas()

        def _keep(self, periods, times) -> None:
            """In Arrow's own format; a timer for the end of the first period."""
            import pyarrow as pa

            if periods.empty:
                self.open.clear()
                return
            table = pa.Table.from_pandas(periods[["key", "first", "last", "n"]], preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            self.open.update((sink.getvalue().to_pybytes(),))
            first = int(periods["last"].min()) + idle_us
            self.handle.registerTimer(max(first // 1000 + 1, times.getCurrentWatermarkInMs() + 1))

    counted = (
        clicks.mapInPandas(reduce, "key string, last_ts timestamp, first bigint, last bigint, n bigint")
        .withWatermark("last_ts", lateness)
        .withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
        .groupBy("part")
        .transformWithStateInPandas(Periods(), f"key string, first bigint, last bigint, n bigint, {gone} boolean", "Update", "EventTime")
    )
    return counted.withColumn("key", F.from_json("key", key_type)).select(
        "key.*",
        F.timestamp_micros("first").alias("period_start"),
        F.timestamp_micros(F.col("last") + idle_us).alias("period_end"),
        F.col("n").alias("click_count"),
        gone,
    )
