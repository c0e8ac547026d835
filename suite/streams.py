"""The streams themselves: each runs over all of a given table and its sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.joins import ROUTED, white_users
from suite.registry import query
from suite.tables import (
    AD_CLICKS,
    ORDERS,
    ad_click_stream,
    order_columns,
    order_stream,
    stream,
    table,
    with_ctes,
    with_instant,
)
from suite.windows import (
    _ORDER_WINDOWS,
    _WINDOW_WORDS,
    AD_PERIODS,
    AD_STATE_SQL,
    CELLS,
    DYNAMIC,
    HOUR,
    TOP_WINDOWS,
    TOTALS,
    message_columns,
    topic_messages,
    window_cte,
)
from tallyloom.plans import ad_clicks as ad_plan
from tallyloom.plans import orders as order_plan
from tallyloom.shared_folder import new_path, staged
from tallyloom.sinks import stores
from tallyloom.sources.streams import stream_text_source, stream_topic_source, stream_union
from tallyloom.streaming import ingest, state, windows
from tallyloom.streaming.runner import batch_time_label, run_to_end


def _plain(df, *columns):
    """Instants back to times without a zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _upserted(spark, df, keys, label):
    path = new_path(spark, label)
    run_to_end(df, stores.upsert_sink(path, keys), new_path(spark, f"{label}-checkpoint"))
    return stores.read_upserted(spark, path, keys)


def _appended(spark, df, label):
    path = new_path(spark, label)
    run_to_end(df, stores.append_sink(path), new_path(spark, f"{label}-checkpoint"), mode="append")
    return spark.read.parquet(path).drop(stores.BATCH)


def _lines_of_events(spark, sf_dir, label):
    """Messages written as text files, for sources that read lines."""
    path = new_path(spark, label)
    message_columns(table(spark, sf_dir, "events")).select("value").write.text(path)
    return path


_LINES = """SELECT event_type || ' k' || regexp_extract(props, '"k": *([0-9]+)', 1) AS "value" FROM events"""


@query("stream_text_source", _LINES)
def _stream_text_source(spark, sf_dir):
    lines = stream_text_source(spark, "text", {"path": _lines_of_events(spark, sf_dir, "lines")})
    return _appended(spark, lines, "text-source")


@query("stream_topic_source", _LINES)
def _stream_topic_source(spark, sf_dir):
    path = _lines_of_events(spark, sf_dir, "topic")
    lines = stream_topic_source(spark, "text", {"path": path}, max_per_trigger=2)
    return _appended(spark, lines, "topic-source")


@query("stream_union_running", "SELECT event_id FROM events UNION ALL SELECT o_orderkey FROM orders")
def _stream_union_running(spark, sf_dir):
    both = stream_union(
        stream(spark, sf_dir, "events").select("event_id"),
        stream(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id")),
    )
    return _appended(spark, both, "union")


@query("stream_word_count_running", f"SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(\"value\", ' ')) AS word FROM ({_LINES})) GROUP BY word")
def _stream_word_count_running(spark, sf_dir):
    """Counts of each batch, added up over the batches."""
    path = new_path(spark, "batch-words")
    write = stores.append_sink(path)
    lines = message_columns(stream(spark, sf_dir, "events"))
    run_to_end(lines, lambda b, n: write(state.stream_word_count(b), n), new_path(spark, "words-checkpoint"), "append")
    return spark.read.parquet(path).groupBy("word").agg(F.sum("cnt").alias("cnt"))


@query("window_word_count_running", _WINDOW_WORDS)
def _window_word_count_running(spark, sf_dir):
    lines = with_instant(message_columns(stream(spark, sf_dir, "events")))
    counts = windows.window_word_count(lines, size="9 hours", slide="6 hours")
    keys = ["window_start", "window_end", "word"]
    return _plain(_upserted(spark, counts, keys, "window-words"), "window_start", "window_end")


@query("window_word_count_late", _WINDOW_WORDS)
def _window_word_count_late(spark, sf_dir):
    """Batches arrive backwards in time; rows far behind the newest one still count because ``lateness`` says so."""
    lines = with_instant(message_columns(stream(spark, sf_dir, "events", newest_first=True)))
    counts = windows.window_word_count(lines, size="9 hours", slide="6 hours", lateness="36500 days")
    keys = ["window_start", "window_end", "word"]
    return _plain(_upserted(spark, counts, keys, "late-words"), "window_start", "window_end")


@query("order_total_running", TOTALS)
def _order_total_running(spark, sf_dir):
    path = new_path(spark, "totals")
    order_plan.start_totals(order_stream(spark, sf_dir), path, new_path(spark, "totals-checkpoint")).awaitTermination()
    return stores.read_upserted(spark, path, ["province_id"])


@query(
    "window_order_count_running",
    _ORDER_WINDOWS + "SELECT window_start, window_end, province_id, count(*) AS cnt FROM w GROUP BY ALL",
)
def _window_order_count_running(spark, sf_dir):
    path = new_path(spark, "order-windows")
    query_ = order_plan.start_window_counts(
        order_stream(spark, sf_dir), path, new_path(spark, "order-windows-checkpoint"), "20 days", "10 days"
    )
    query_.awaitTermination()
    counts = stores.read_upserted(spark, path, order_plan.WINDOW_KEYS)
    return _plain(counts, "window_start", "window_end")


@query("dynamic_blacklist_running", DYNAMIC)
def _dynamic_blacklist_running(spark, sf_dir):
    root = new_path(spark, "ads")
    ad_plan.start_blacklist(
        ad_click_stream(spark, sf_dir),
        white_users(spark, sf_dir),
        root,
        new_path(spark, "ads-checkpoint"),
        threshold=10,
        window=("60 hours", "18 hours"),
    ).awaitTermination()
    return stores.read_set(spark, f"{root}/blacklist", "user_id")


@query(
    "ad_click_plan_running",
    with_ctes(AD_CLICKS, window_cte("w", "ad_clicks", "user_id", 60 * 3600, 18 * 3600))
    + """, black AS (SELECT user_id FROM (SELECT user_id, window_start FROM w GROUP BY ALL HAVING count(*) > 10)
           WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)),
         allowed AS (SELECT * FROM ad_clicks WHERE user_id NOT IN (SELECT user_id FROM black))
         SELECT date, province, ad_id, click_count, CAST(r - 1 AS INTEGER) AS rank FROM (
           SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS r FROM (
             SELECT strftime(ts, '%Y%m%d') AS date, province, ad_id, count(*) AS click_count
             FROM allowed GROUP BY ALL)) WHERE r <= 5""",
)
def _ad_click_plan_running(spark, sf_dir):
    """Blacklist first, then the clicks of everybody else, then the ranking."""
    root, checkpoint = new_path(spark, "ads"), new_path(spark, "ads-checkpoint")
    clicks = ad_click_stream(spark, sf_dir)
    ad_plan.start_blacklist(
        clicks, white_users(spark, sf_dir), root, checkpoint, threshold=10, window=("60 hours", "18 hours")
    ).awaitTermination()
    ad_plan.start_click_counts(clicks, root, checkpoint).awaitTermination()
    return ad_plan.province_ranking(spark, root)


@query(
    "ad_click_window_running",
    with_ctes(AD_CLICKS, window_cte("w", "ad_clicks", "ad_id", 10 * HOUR, HOUR))
    + """, over AS (SELECT *, max(window_start) OVER () AS newest FROM w
           WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM ad_clicks))
         SELECT strftime(window_start, '%Y/%m/%d %H:%M:%S') AS window_start, strftime(window_end, '%Y/%m/%d %H:%M:%S') AS window_end,
                ad_id, count(*) AS click_count FROM over WHERE window_start = newest GROUP BY ALL""",
)
def _ad_click_window_running(spark, sf_dir):
    """The target holds one window: the newest that was over by the watermark."""
    root = new_path(spark, "recent")
    ad_plan.start_recent_clicks(ad_click_stream(spark, sf_dir), root, new_path(spark, "recent-checkpoint"), ("10 hours", "1 hour")).awaitTermination()
    return ad_plan.recent_clicks(spark, root)


@query(
    "province_top5_running",
    with_ctes(AD_CLICKS)
    + """, counted AS (SELECT strftime(ts, '%Y%m%d') AS date, province, ad_id, count(*) AS click_count, max(ts) AS last
           FROM ad_clicks GROUP BY ALL),
         live AS (SELECT * FROM counted WHERE last >= (SELECT max(ts) - INTERVAL 4 DAY FROM ad_clicks))
         SELECT date, province, CAST(r - 1 AS INTEGER) AS rank, ad_id, click_count FROM (
           SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS r FROM live) WHERE r <= 5""",
)
def _province_top5_running(spark, sf_dir):
    """Ads leave the ranking after four days, so most ranks that earlier batches wrote are taken back."""
    root = new_path(spark, "top5")
    ad_plan.start_province_top5(ad_click_stream(spark, sf_dir), root, new_path(spark, "top5-checkpoint"), idle="4 days").awaitTermination()
    return ad_plan.province_top5(spark, root)


@query(
    "window_top5_running",
    TOP_WINDOWS + " AND window_end <= (SELECT max(o_orderdate)::TIMESTAMP - INTERVAL 10 MINUTE FROM orders)",
)
def _window_top5_running(spark, sf_dir):
    """Two aggregations in a row on the stream itself; nothing is read back before the end."""
    path = new_path(spark, "window-top")
    order_plan.start_window_top(
        order_stream(spark, sf_dir), path, new_path(spark, "window-top-checkpoint"), "20 days", "8 days"
    ).awaitTermination()
    return _plain(spark.read.parquet(path).drop(stores.BATCH), "window_start", "window_end")


@query("ad_click_state_running", AD_STATE_SQL)
def _ad_click_state_running(spark, sf_dir):
    counts = state.ad_click_state(ad_click_stream(spark, sf_dir))
    return _upserted(spark, counts, list(state.STATE_KEYS), "ad-state")


@query(
    "ad_click_state_expiring_running",
    AD_PERIODS + "SELECT * FROM periods WHERE period_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
)
def _ad_click_state_expiring_running(spark, sf_dir):
    """The periods that were over by the watermark: ten minutes before the latest click."""
    path = new_path(spark, "periods")
    periods = state.ad_click_state_expiring(ad_click_stream(spark, sf_dir), idle="12 hours")
    run_to_end(periods, stores.append_sink(path), new_path(spark, "periods-checkpoint"), mode="append")
    return _plain(spark.read.parquet(path).drop(stores.BATCH), "period_start", "period_end")


@query("ad_click_periods_running", AD_PERIODS + "SELECT * FROM periods")
def _ad_click_periods_running(spark, sf_dir):
    """Periods while they run, with the clock of Shanghai; a batch holds several periods of a key."""
    root = new_path(spark, "click-periods")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        clicks = ad_click_stream(spark, sf_dir)
        ad_plan.start_click_periods(clicks, root, new_path(spark, "click-periods-checkpoint"), idle="12 hours").awaitTermination()
        local = _plain(ad_plan.click_periods(spark, root), "period_start", "period_end")
        return staged(local, "click-periods")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@query("stream_route_by_type", with_ctes(ORDERS, ROUTED) + "SELECT order_id, order_type, target FROM routed")
def _stream_route_by_type(spark, sf_dir):
    path = new_path(spark, "routes")
    routed = ingest.stream_route_by_type(order_stream(spark, sf_dir).select("order_id", "order_type"))
    run_to_end(routed, ingest.folder_sink(path, "target"), new_path(spark, "routes-checkpoint"), mode="append")
    return spark.read.parquet(path).drop(stores.BATCH)


@query("topic_ingest_running", CELLS)
def _topic_ingest_running(spark, sf_dir):
    path = new_path(spark, "ingest")
    cells = ingest.topic_ingest_exactly(topic_messages(stream(spark, sf_dir, "events")))
    run_to_end(cells, ingest.folder_sink(path, "table"), new_path(spark, "ingest-checkpoint"), mode="append")
    return spark.read.parquet(path).drop(stores.BATCH)


@query("resume_from_checkpoint", TOTALS)
def _resume_from_checkpoint(spark, sf_dir):
    """One part of the orders, a stop, the rest with the same checkpoint: totals of all."""
    inbox, path, checkpoint = (new_path(spark, n) for n in ("inbox", "totals", "totals-checkpoint"))
    rows = with_instant(order_columns(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")))
    early = F.col("ts") < "1997-01-01"
    for part in (rows.filter(early), rows.filter(~early)):
        part.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(rows.schema).parquet(inbox)
        order_plan.start_totals(arriving, path, checkpoint).awaitTermination()
    return stores.read_upserted(spark, path, ["province_id"])


@query("totals_after_new_checkpoint", TOTALS)
def _totals_after_new_checkpoint(spark, sf_dir):
    """The checkpoint is lost after one part of the orders: totals go on from those in the store."""
    path = new_path(spark, "totals")
    rows = with_instant(order_columns(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")))
    early = F.col("ts") < "1997-01-01"
    for generation, part in enumerate((rows.filter(early), rows.filter(~early | F.col("ts").isNull()))):
        inbox = new_path(spark, "inbox")
        part.repartition(3).write.parquet(inbox)
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        checkpoint = new_path(spark, "totals-checkpoint")
        order_plan.start_totals(arriving, path, checkpoint, generation=generation).awaitTermination()
    return stores.read_upserted(spark, path, ["province_id"])


@query(
    "upsert_compacted",
    """SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS newest FROM orders
       WHERE o_orderkey % 30 = (SELECT max(o.o_orderkey % 30) FROM orders o WHERE o.o_custkey = orders.o_custkey) GROUP BY o_custkey""",
)
def _upsert_compacted(spark, sf_dir):
    """Thirty batches; the store merges them as they come."""
    path = new_path(spark, "compacted")
    rows = table(spark, sf_dir, "orders")
    write = stores.upsert_sink(path, ["o_custkey"])
    for n in range(30):
        part = rows.where(F.col("o_orderkey") % 30 == n)
        write(part.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("newest")), n)
    return stores.read_upserted(spark, path, ["o_custkey"])


@query(
    "topic_log_running",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "key",
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',' || o_custkey AS "value" FROM orders""",
)
def _topic_log_running(spark, sf_dir):
    """Every batch is sent twice, as after a failure before the checkpoint; its messages are there once."""
    path = new_path(spark, "topic-log")
    send = stores.topic_log_sink(path, "o_orderkey", ["at", "o_custkey"])

    def twice(batch, n):
        send(batch, n)
        send(batch, n)

    rows = stream(spark, sf_dir, "orders").withColumn("at", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    run_to_end(rows, twice, new_path(spark, "topic-log-checkpoint"), "append")
    return stores.read_topic(spark, path)


_PRICES = """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN -o_totalprice ELSE o_totalprice END AS price,
                    CAST(o_orderkey % 2 = 0 AS INTEGER) AS run FROM orders"""


def _prices(spark, sf_dir, run):
    """The prices of all orders in run 0; in run 1 those of even orders with another sign."""
    rows, price = stream(spark, sf_dir, "orders"), F.col("o_totalprice")
    rows = rows.where("o_orderkey % 2 = 0") if run else rows
    return rows.select("o_orderkey", (-price if run else price).alias("price"), F.lit(run).alias("run"))


@query("upsert_after_new_checkpoint", _PRICES)
def _upsert_after_new_checkpoint(spark, sf_dir):
    """The batch ids of a second stream start at 0 again; its rows are the newer ones all the same."""
    path = new_path(spark, "prices")
    for run in (0, 1):
        write = stores.upsert_sink(path, ["o_orderkey"], generation=run)
        run_to_end(_prices(spark, sf_dir, run), write, new_path(spark, "prices-checkpoint"), "append")
    return stores.read_upserted(spark, path, ["o_orderkey"])


@query("fold_then_append", _PRICES)
def _fold_then_append(spark, sf_dir):
    """A store is folded, and a new stream goes on with the folded one from batch 0."""
    path, folded, keys = new_path(spark, "prices"), new_path(spark, "folded"), ["o_orderkey"]
    run_to_end(_prices(spark, sf_dir, 0), stores.upsert_sink(path, keys), new_path(spark, "prices-checkpoint"), "append")
    stores.fold_upserts(spark, path, keys, folded)
    run_to_end(_prices(spark, sf_dir, 1), stores.upsert_sink(folded, keys), new_path(spark, "folded-checkpoint"), "append")
    return stores.read_upserted(spark, folded, keys)


@query("set_after_new_checkpoint", "SELECT DISTINCT o_custkey FROM orders")
def _set_after_new_checkpoint(spark, sf_dir):
    """Members of both streams stay, although the second one starts at batch 0."""
    path = new_path(spark, "members")
    for run in (0, 1):
        members = stream(spark, sf_dir, "orders").where(F.col("o_orderkey") % 2 == run)
        run_to_end(members, stores.set_sink(path, "o_custkey", generation=run), new_path(spark, "members-checkpoint"), "append")
    return stores.read_set(spark, path, "o_custkey")


@query("batch_time_label", "SELECT event_type, count(*) AS cnt, 1 AS labels FROM events GROUP BY event_type")
def _batch_time_label(spark, sf_dir):
    """Every row of a batch carries one and the same time."""
    path = new_path(spark, "labelled")
    write = stores.append_sink(path)
    lines = stream(spark, sf_dir, "events").select("event_type")
    run_to_end(lines, lambda b, n: write(batch_time_label(b), n), new_path(spark, "labelled-checkpoint"), "append")
    labelled = spark.read.parquet(path)
    per_batch = labelled.groupBy("event_type", stores.BATCH).agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("batch_time").cast("int").alias("labels")
    )
    return per_batch.groupBy("event_type").agg(F.sum("cnt").alias("cnt"), F.max("labels").alias("labels"))
