import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import ad_clicks as ad_plan
from tallyloom.plans import orders as order_plan
from tallyloom.sinks import stores
from tallyloom.streaming import ingest, state, windows
from tallyloom.streaming.runner import run_to_end

START = dt.datetime(2018, 10, 8, 12, 0, 0, tzinfo=dt.timezone.utc)
CLICK = "ts timestamp, province string, city string, user_id long, ad_id long"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


class Inbox:
    """A folder that a stream reads; every delivery is one file."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def deliver(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, per_batch=1):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", per_batch).parquet(self.path)


def test_order_totals_go_on_after_a_stop(spark, tmp_path, rows):
    inbox = Inbox(spark, tmp_path / "in", "province_id string, order_price double")
    seen = []
    for batch in ([("bj", 100.0), ("sh", 300.0), ("hz", 240.0)], [("bj", 1000.0), ("sh", 40.0), ("nj", 80.0)]):
        inbox.deliver(batch)
        totals = state.order_total_mapped_state(inbox.stream())
        write = stores.hash_sink(str(tmp_path / "out"), "province_id")
        run_to_end(totals, lambda b, n: (seen.append(b.count()), write(b, n)), str(tmp_path / "cp"))
    assert rows(stores.read_upserted(spark, str(tmp_path / "out"), ["province_id"])) == [
        ("bj", 1100.0), ("hz", 240.0), ("nj", 80.0), ("sh", 340.0),
    ]
    assert [n for n in seen if n] == [3, 3], "a batch gives the keys it touched and no others"


def test_windows_of_a_stream_equal_those_of_its_rows(spark, tmp_path, rows):
    orders = [(at(3 * i), i % 4) for i in range(60)]
    inbox = Inbox(spark, tmp_path / "in", "ts timestamp, province_id int")
    for part in (orders[:30], orders[30:]):
        inbox.deliver(part)
    order_plan.start_window_counts(inbox.stream(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    stored = stores.read_upserted(spark, str(tmp_path / "out"), order_plan.WINDOW_KEYS)
    static = spark.createDataFrame(orders, inbox.schema)
    twin = windows.window_order_count(static, "ts", "20 seconds", "8 seconds")
    assert rows(stored.select(twin.columns)) == rows(twin)
    newest = order_plan.latest_window_top(spark, str(tmp_path / "out"), 2)
    assert {r["window_start"] for r in newest.collect()} == {max(r["window_start"] for r in stored.collect())}


@pytest.mark.parametrize("size, slide", [("60 seconds", "6 seconds"), ("60 seconds", "18 seconds"), ("20 seconds", "8 seconds"), ("9 seconds", "6 seconds"), ("10 seconds", "10 seconds")])
def test_panes_give_the_same_windows(spark, rows, size, slide):
    df = spark.createDataFrame([(at(0.7 * i), i % 3) for i in range(200)], "ts timestamp, k int")
    plain = windows.window_counts(df, "ts", ["k"], size, slide)
    assert rows(windows.window_counts(df, "ts", ["k"], size, slide, by_pane=True)) == rows(plain)
    length, step = windows.seconds(size), windows.seconds(slide)
    assert plain.agg(F.sum("cnt")).first()[0] == sum(
        1
        for i in range(200)
        for s in range(int(at(0).timestamp() - 100) // step * step, int(at(200).timestamp()), step)
        if s <= at(0.7 * i).timestamp() < s + length
    )


def clicks_of(user, times, ad=1):
    return [(at(t), "p", "c", user, ad) for t in times]


def test_blacklist_threshold_and_white_list(spark, rows):
    given = clicks_of(1, range(4)) + clicks_of(2, range(3)) + clicks_of(3, range(4)) + clicks_of(4, range(0, 800, 200))
    df = spark.createDataFrame(given, CLICK)
    white = spark.createDataFrame([(3,)], "user_id long")
    assert rows(windows.dynamic_blacklist(df, white, threshold=3)) == [(1,)]
    assert rows(windows.dynamic_blacklist(df, white, threshold=3, inclusive=True)) == [(1,), (2,)]


def test_listed_users_stay_out_of_later_batches(spark, tmp_path, rows):
    inbox = Inbox(spark, tmp_path / "in", CLICK)
    white = spark.createDataFrame([], "user_id long")
    root, cp = str(tmp_path / "root"), str(tmp_path / "cp")
    inbox.deliver(clicks_of(1, range(5)) + clicks_of(2, [1]))
    ad_plan.start_click_counts(inbox.stream(), root, cp).awaitTermination()
    ad_plan.start_blacklist(inbox.stream(), white, root, cp, threshold=3).awaitTermination()
    inbox.deliver(clicks_of(1, [300]) + clicks_of(2, [300]))
    ad_plan.start_click_counts(inbox.stream(), root, cp).awaitTermination()
    ad_plan.start_blacklist(inbox.stream(), white, root, cp, threshold=3).awaitTermination()
    assert rows(stores.read_set(spark, f"{root}/blacklist", "user_id")) == [(1,)]
    assert rows(ad_plan.click_state(spark, root)) == [("20181008", "p", "c", 1, 7)]
    assert rows(ad_plan.province_ranking(spark, root)) == [("20181008", "p", 1, 7, 0)]


def test_counts_of_a_batch_that_is_run_again(spark, tmp_path, rows):
    write = stores.count_sink(str(tmp_path / "s"), ["k"])
    batch = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    write(batch, 0)
    write(batch, 1)
    write(batch, 1)
    assert rows(stores.read_counts(spark, str(tmp_path / "s"), ["k"])) == [("a", 4), ("b", 2)]


def test_idle_keys_start_again(spark, rows):
    times = [0, 10, 20, 56.5, 92.5, 93]
    got = state.ad_click_state_expiring(spark.createDataFrame(clicks_of(1, times), CLICK), idle="36 seconds")
    # 20 to 56.5 is more than 36 seconds; 56.5 to 92.5 is exactly that and no end yet.
    assert sorted(r["click_count"] for r in got.collect()) == [3, 3]
    many = [t * 7.3 for t in range(400)] + [4000 + t for t in range(50)] + [9000.0]
    got = state.ad_click_state_expiring(spark.createDataFrame(clicks_of(1, many), CLICK), idle="36 seconds")
    assert sorted(r["click_count"] for r in got.collect()) == [1, 50, 400]


def test_running_counts_of_idle_keys(spark, tmp_path):
    inbox = Inbox(spark, tmp_path / "in", CLICK)
    for part in (clicks_of(1, [0, 1]) + clicks_of(2, [0]), clicks_of(1, [30]), clicks_of(2, [500]), clicks_of(1, [510])):
        inbox.deliver(part)
        seen = {}
        counts = state.ad_click_state_expiring_updates(
            inbox.stream().withColumn("ad_id", F.col("user_id")), idle="60 seconds"
        )
        run_to_end(
            counts,
            lambda b, n: seen.update({r["ad_id"]: r["click_count"] for r in b.collect()}),
            str(tmp_path / "cp"),
        )
        if part[0][3] == 1 and part[0][0] == at(30):
            assert seen == {1: 3}
    assert seen == {1: 1}, "after 480 idle seconds the count starts again"


def test_periods_while_they_run(spark, tmp_path):
    inbox, root, cp = Inbox(spark, tmp_path / "in", CLICK), str(tmp_path / "root"), str(tmp_path / "cp")

    def after(*parts, lateness="0 seconds"):
        for part in parts:
            inbox.deliver(part)
        ad_plan.start_click_periods(inbox.stream(), root, cp, "60 seconds", lateness=lateness).awaitTermination()
        rows = ad_plan.click_periods(spark, root).collect()
        return sorted((r.ad_id, r.period_start.timestamp() - START.timestamp(), r.click_count) for r in rows)

    assert after(clicks_of(1, [0, 1], ad=1) + clicks_of(2, [0], ad=2)) == [(1, 0, 2), (2, 0, 1)]
    # A gap within one batch: the third click opens a period of its own.
    assert after(clicks_of(1, [30, 200, 210], ad=1)) == [(1, 0, 3), (1, 200, 2), (2, 0, 1)]
    assert after(clicks_of(2, [500], ad=2)) == [(1, 0, 3), (1, 200, 2), (2, 0, 1), (2, 500, 1)]
    assert after(clicks_of(1, [510], ad=1)) == [(1, 0, 3), (1, 200, 2), (1, 510, 1), (2, 0, 1), (2, 500, 1)]


def test_late_clicks_join_periods(spark, tmp_path):
    inbox, root, cp = Inbox(spark, tmp_path / "in", CLICK), str(tmp_path / "root"), str(tmp_path / "cp")
    for times in ([0, 100, None], [50], [40, -10]):
        inbox.deliver([(None if t is None else at(t), "p", None, 1, 7) for t in times if t is not None])
        ad_plan.start_click_periods(inbox.stream(), root, cp, "60 seconds", lateness="10 minutes").awaitTermination()
        found = [(r.city, r.period_start.timestamp() - START.timestamp(), r.click_count) for r in ad_plan.click_periods(spark, root).collect()]
    assert found == [(None, -10, 5)]


def test_ingest_replays_and_bad_messages(spark, tmp_path, rows):
    messages = [("t1", '{"r":"1","f":"i","q":["a","b"],"v":["x","y"]}'), ("t2", '{"r":"2","f":"i","q":["a"],"v":["z"]}'), ("t1", "broken")]
    cells = ingest.topic_ingest_exactly(spark.createDataFrame(messages, "topic string, value string"))
    write = ingest.folder_sink(str(tmp_path / "out"), "table")
    write(cells, 0)
    write(cells, 0)
    stored = spark.read.parquet(str(tmp_path / "out")).select("table", "rowkey", "family", "qualifier", "value")
    assert rows(stored) == [("t1", "1", "i", "a", "x"), ("t1", "1", "i", "b", "y"), ("t2", "2", "i", "a", "z")]


def test_streamed_tables_arrive_in_batches_of_time_without_losing_rows(spark, tmp_path, monkeypatch):
    import datetime

    from suite import tables

    day = datetime.datetime(2024, 1, 1)
    rows = [(i, day + datetime.timedelta(days=i * i)) for i in range(40)] + [(40, None)]
    spark.createDataFrame(rows, "k int, ts timestamp_ntz").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for newest_first in (False, True):
        seen = {}
        run_to_end(
            tables.stream(spark, str(tmp_path), "events", newest_first),
            lambda batch, n, seen=seen: seen.__setitem__(n, [r.k for r in batch.collect()]),
            str(tmp_path / f"checkpoint-{newest_first}"),
            "append",
        )
        batches = [sorted(seen[n]) for n in sorted(seen)][:: -1 if newest_first else 1]
        assert len(batches) == tables.BATCHES
        assert sorted(k for b in batches for k in b) == list(range(41))
        dated = [[k for k in b if k < 40] for b in batches]
        assert [k for b in dated for k in b] == list(range(40))
