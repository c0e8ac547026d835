"""Stores of versions: what readers see while things are written, merged, repeated and broken off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import ad_clicks as ad_plan
from tallyloom.plans import orders as order_plan
from tallyloom.sinks import stores
from tallyloom.sinks.versions import Store
from tallyloom.streaming import windows
from tallyloom.streaming.runner import run_to_end

START = dt.datetime(2018, 10, 8, 12, 0, 0, tzinfo=dt.timezone.utc)
CLICK = "ts timestamp, province string, city string, user_id long, ad_id long"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string")


def values(spark, path, version=None):
    return {r.k: r.v for r in stores.read_upserted(spark, path, ["k"], version=version).collect()}


def test_many_batches_leave_few_folders(spark, tmp_path):
    path, expected, opened = str(tmp_path / "s"), {}, []
    write = stores.upsert_sink(path, ["k"], fan_in=3)
    for n in range(20):
        batch = {n % 7: f"v{n}", 100 + n: "x", None: f"n{n}"}
        write(kv(spark, *batch.items()), n)
        expected |= batch
        opened.append(len(Store(spark, path).version().runs))
    assert values(spark, path) == expected
    assert max(opened) <= 2 * 3, "at most two runs in each of three tiers"
    assert len(list((tmp_path / "s" / "versions").glob("*.json"))) <= Store(spark, path).keep + 3
    assert len(list((tmp_path / "s" / "rows").glob("*/attempt=*"))) < 20, "merged folders go when no kept version names them"


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path)
    write = stores.upsert_sink(path, ["k"], fan_in=2)
    write(kv(spark, (1, "a")), 0)
    number = Store(spark, path).version().number
    pinned = stores.read_upserted(spark, path, ["k"], version=number)
    for n in (1, 2):
        write(kv(spark, (1, f"b{n}")), n)
    assert [r.v for r in pinned.collect()] == ["a"]
    assert values(spark, path, number) == {1: "a"} and values(spark, path) == {1: "b2"}


def test_a_broken_off_merge_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    write = stores.upsert_sink(path, ["k"], fan_in=2)
    write(kv(spark, (1, "a"), (2, "a")), 0)
    whole = Store._write

    def breaks(self, rows, number, tier):
        run = whole(self, rows, number, tier)
        if tier:
            raise OSError("gone")
        return run

    monkeypatch.setattr(Store, "_write", breaks)
    with pytest.raises(OSError):
        write(kv(spark, (2, "b")), 1)
    assert values(spark, path) == {1: "a", 2: "b"}, "the batch was published, its merge was not"
    monkeypatch.setattr(Store, "_write", whole)
    write(kv(spark, (2, "b")), 1)
    write(kv(spark, (3, "c")), 2)
    assert values(spark, path) == {1: "a", 2: "b", 3: "c"}


def test_old_generations_are_refused(spark, tmp_path):
    path = str(tmp_path)
    stores.upsert_sink(path, ["k"])(kv(spark, (1, "a")), 5)
    stores.upsert_sink(path, ["k"])(kv(spark, (1, "again")), 5)
    assert values(spark, path) == {1: "a"}, "a batch that the store has is left out"
    stores.upsert_sink(path, ["k"], generation=2)(kv(spark, (1, "b")), 0)
    with pytest.raises(ValueError, match="generation 1 is over"):
        stores.upsert_sink(path, ["k"], generation=1)(kv(spark, (1, "c")), 9)
    assert values(spark, path) == {1: "b"}


def test_a_second_stream_needs_a_generation(spark, tmp_path):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "out")
    kv(spark, (1, "a")).write.parquet(inbox)
    read = lambda: spark.readStream.schema("k long, v string").parquet(inbox)
    run_to_end(read(), stores.upsert_sink(path, ["k"]), str(tmp_path / "cp0"), "append")
    with pytest.raises(Exception, match="another stream"):
        run_to_end(read(), stores.upsert_sink(path, ["k"]), str(tmp_path / "cp1"), "append")
    run_to_end(read(), stores.upsert_sink(path, ["k"], generation=1), str(tmp_path / "cp2"), "append")


def test_repeated_keys(spark, tmp_path):
    batch = kv(spark, (1, "a"), (1, "b"))
    with pytest.raises(ValueError, match="twice"):
        stores.upsert_sink(str(tmp_path / "a"), ["k"])(batch, 0)
    assert Store(spark, str(tmp_path / "a")).versions() == []
    rows = batch.withColumn("at", F.when(F.col("v") == "a", 2).otherwise(1))
    stores.upsert_sink(str(tmp_path / "b"), ["k"], newest="at")(rows, 0)
    assert values(spark, str(tmp_path / "b")) == {1: "a"}


def test_deleted_keys(spark, tmp_path):
    path = str(tmp_path)
    write = stores.upsert_sink(path, ["k"], fan_in=2)
    gone = lambda *rows: spark.createDataFrame(list(rows), "k long, v string, _gone boolean")
    write(kv(spark, (1, "a"), (2, "a")), 0)
    write(gone((1, None, True), (3, "c", False)), 1)
    assert values(spark, path) == {2: "a", 3: "c"}
    write(gone((1, "back", None), (2, None, True)), 2)
    write(gone((9, None, True)), 3)
    assert values(spark, path) == {1: "back", 3: "c"}
    wanted = kv(spark, (1, "back"), (4, "d"))
    changes = stores.changed_rows(stores.read_upserted(spark, path, ["k"]), wanted, ["k"])
    assert {(r.k, r.v, r._gone) for r in changes.collect()} == {(3, None, True), (4, "d", False)}


def test_empty_stores_and_counts(spark, tmp_path, rows):
    path = str(tmp_path / "c")
    assert stores.read_counts(spark, path, ["k"], schema="k string, click_count bigint").count() == 0
    with pytest.raises(ValueError):
        stores.read_counts(spark, path, ["k"])
    write = stores.count_sink(path, ["k"], fan_in=2)
    batch = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    for n in range(5):
        write(batch, n)
    write(batch, 4)
    write(batch.where("false"), 5)
    assert rows(stores.read_counts(spark, path, ["k"])) == [("a", 10), (None, 5)]
    assert len(Store(spark, path).version().runs) <= 3


def test_topic_log(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert stores.read_topic(spark, path).count() == 0
    send = stores.topic_log_sink(path, "k", ["v"], fan_in=2)
    for n in (0, 0, 1, 1, 2):
        send(kv(spark, (n, "x"), (n, "x")), n)
    assert rows(stores.read_topic(spark, path)) == [(str(n), "x") for n in (0, 0, 1, 1, 2, 2)]


def test_totals_go_on_in_a_new_generation(spark, tmp_path):
    path = str(tmp_path / "t")
    total = lambda *rows: spark.createDataFrame(list(rows), "province_id string, total double")
    write = stores.total_sink(path, ["province_id"], "total")
    write(total(("a", 1.5), (None, 2.0)), 0)
    write(total(("a", 3.5)), 1)
    for generation in (1, 2):
        write = stores.total_sink(path, ["province_id"], "total", generation)
        for _ in range(2):  # the first batch is run again
            write(total(("a", 0.1), ("b", 1.0)), 0)
        write(total(("a", 0.3), (None, 1.0)), 1)
    got = {r.province_id: r.total for r in stores.read_upserted(spark, path, ["province_id"]).collect()}
    assert got == {"a": 4.1, "b": 2.0, None: 4.0}


def click(second, ad=1, user=1):
    return (START + dt.timedelta(seconds=second), "p", "c", user, ad)


def deliver(spark, path, rows):
    spark.createDataFrame(rows, CLICK).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(CLICK).option("maxFilesPerTrigger", 1).parquet(path)


def test_recent_clicks_are_old_or_new_but_never_half(spark, tmp_path, monkeypatch):
    inbox, root, cp = str(tmp_path / "in"), str(tmp_path / "root"), str(tmp_path / "cp")
    start = lambda c: ad_plan.start_recent_clicks(c, root, cp, ("60 seconds", "60 seconds"), lateness="0 seconds").awaitTermination()
    assert ad_plan.recent_clicks(spark, root).count() == 0
    start(deliver(spark, inbox, [click(1), click(2, ad=2), click(61)]))
    first = sorted(map(tuple, ad_plan.recent_clicks(spark, root).collect()))
    assert [r[2:] for r in first] == [(1, 1), (2, 1)]
    publish = Store._publish

    def breaks(self, *args, **kwargs):
        raise OSError("between writing and switching")

    monkeypatch.setattr(Store, "_publish", breaks)
    with pytest.raises(Exception, match="between writing"):
        start(deliver(spark, inbox, [click(62), click(121)]))
    assert sorted(map(tuple, ad_plan.recent_clicks(spark, root).collect())) == first
    monkeypatch.setattr(Store, "_publish", publish)
    start(spark.readStream.schema(CLICK).option("maxFilesPerTrigger", 1).parquet(inbox))
    assert [tuple(r)[2:] for r in ad_plan.recent_clicks(spark, root).collect()] == [(1, 2)]


def test_ranks_that_lose_their_ad_are_deleted(spark, tmp_path):
    inbox, root, cp = str(tmp_path / "in"), str(tmp_path / "root"), str(tmp_path / "cp")
    seen = []
    for rows in ([click(0, 1), click(0, 1), click(0, 2), click(0, 3)], [click(50, 2), click(50, 2)], [click(130, 4)], [click(135, 3)]):
        ad_plan.start_province_top5(deliver(spark, inbox, rows), root, cp, n=2, idle="100 seconds").awaitTermination()
        seen.append([(r["rank"], r.ad_id, r.click_count) for r in ad_plan.province_top5(spark, root).orderBy("rank").collect()])
    assert seen == [[(0, 1, 2), (1, 2, 1)], [(0, 2, 3), (1, 1, 2)], [(0, 2, 3), (1, 4, 1)], [(0, 2, 3), (1, 3, 2)]]
    ad_plan.start_province_top5(deliver(spark, inbox, [click(900, 9)]), root, cp, n=2, idle="100 seconds").awaitTermination()
    assert [(r["rank"], r.ad_id) for r in ad_plan.province_top5(spark, root).collect()] == [(0, 9)]


@pytest.mark.parametrize("size, slide", [("20 seconds", "8 seconds"), ("9 seconds", "6 seconds"), ("10 seconds", "10 seconds")])
def test_tops_of_closed_windows(spark, tmp_path, rows, size, slide):
    orders = [(START + dt.timedelta(seconds=3 * i), i * i % 7) for i in range(60)]
    inbox, path = str(tmp_path / "in"), str(tmp_path / "out")
    for a in range(0, 60, 12):
        spark.createDataFrame(orders[a : a + 12], "ts timestamp, province_id int").coalesce(1).write.mode("append").parquet(inbox)
    arriving = spark.readStream.schema("ts timestamp, province_id int").option("maxFilesPerTrigger", 1).parquet(inbox)
    query = order_plan.start_window_top(arriving, path, str(tmp_path / "cp"), size, slide, n=3, lateness="0 seconds")
    query.awaitTermination()
    assert len(query.lastProgress["stateOperators"]) == 2
    twin = windows.window_top5_provinces(spark.createDataFrame(orders, "ts timestamp, province_id int"), "ts", size, slide, n=3)
    got = spark.read.parquet(path).drop(stores.BATCH)
    assert rows(got.select(twin.columns)) == rows(twin.where(F.col("window_end") <= orders[-1][0]))
