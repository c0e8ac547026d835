"""Bad lines, late rows, new checkpoints, other session zones."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import enrich, parsing, routing
from tallyloom.sinks import stores
from tallyloom.sources.files import read_text_pairs
from tallyloom.streaming import state, windows


def test_one_line_with_many_fields_and_a_repeated_key(spark):
    fields = "&".join(f"k{i}={i}" for i in range(100_000))
    line = f"1.2.3.4^A1^Ahost^A/p?a=1&{fields}&a=2&b&a=3&ip=9.9.9.9"
    got = parsing.parse_event_log(spark.createDataFrame([(line,)], "value string")).select(
        F.col("fields")["a"], F.col("fields")["k99999"], F.size("fields"), F.col("fields")["ip"]
    )
    assert tuple(got.first()) == ("3", "99999", 100_005, "9.9.9.9")


def test_numbers_that_are_none_leave_the_row_out(spark, tmp_path):
    lines = spark.createDataFrame([("1 p c 2 3",), ("x p c 2 3",), ("1 p c 2 y",)], "value string")
    assert parsing.parse_ad_clicks(lines).count() == 1
    (tmp_path / "pairs.txt").write_text("a 1\nb x\nc 3\n")
    assert sorted(r.key for r in read_text_pairs(spark, str(tmp_path)).collect()) == ["a", "c"]


def test_addresses(spark):
    ranges = spark.createDataFrame([(0, 2**32 - 1, "日本")], "lo long, hi long, area string")
    df = spark.createDataFrame([("1.2.3.4",), ("1.2.3.300",), ("1.2.-4.3",), ("",), (None,)], "ip string")
    got = {r.ip: r.country for r in enrich.enrich_region(df, "ip", ranges).collect()}
    assert got == {"1.2.3.4": "日本", "1.2.3.300": "中国", "1.2.-4.3": "中国", "": "中国", None: "中国"}


def test_intervals():
    assert [windows.seconds(x) for x in ("1 week", "500 milliseconds", "INTERVAL 1 minute 30 seconds", "2 days")] == [604800, 0.5, 90, 172800]
    with pytest.raises(ValueError):
        windows.seconds("3 parsecs")


def test_split_by_hash(spark):
    df = spark.range(10_000).withColumn("v", F.col("id") % 7)
    train, test = routing.train_test_split(df)
    assert 7800 < train.count() < 8200 and train.join(test, "id").count() == 0
    again, _ = routing.train_test_split(df.repartition(13))
    assert again.exceptAll(train).count() == 0


def test_a_store_over_folding_and_a_new_checkpoint(spark, tmp_path):
    batch = lambda *rows: spark.createDataFrame(rows, "k long, v string")
    first, folded = str(tmp_path / "a"), str(tmp_path / "b")
    assert stores.read_upserted(spark, first, ["k"], "k long, v string").count() == 0
    write = stores.upsert_sink(first, ["k"])
    write(batch((1, "a"), (2, "a")), 0)
    write(batch((1, "b")), 5)
    stores.fold_upserts(spark, first, ["k"], folded)
    stores.upsert_sink(folded, ["k"])(batch((3, "c")), 0)
    values = lambda p: {r.k: r.v for r in stores.read_upserted(spark, p, ["k"]).collect()}
    assert values(folded) == {1: "b", 2: "a", 3: "c"}
    stores.upsert_sink(first, ["k"], generation=1)(batch((1, "new")), 0)
    assert values(first) == {1: "new", 2: "a"}
    members = str(tmp_path / "c")
    stores.set_sink(members, "k")(batch((1, "")), 0)
    stores.set_sink(members, "k", generation=1)(batch((2, "")), 0)
    assert {r.k for r in stores.read_set(spark, members, "k").collect()} == {1, 2}


def clicks(spark, folder, deliveries):
    for i, rows in enumerate(deliveries):
        instants = [(datetime.datetime.fromtimestamp(s, datetime.timezone.utc),) for s in rows]
        frame = spark.createDataFrame(instants, "ts timestamp").select("ts", F.lit("p").alias("province"), F.lit("c").alias("city"), F.lit(1).alias("ad_id"), F.lit(7).alias("province_id"))
        frame.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1)  # files are taken in the order of their times
    return spark.readStream.schema("ts timestamp, province string, city string, ad_id int, province_id int").option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.mark.parametrize("lateness, total", [("10 minutes", 6), ("2 hours", 8)])
def test_late_rows_count_if_lateness_says_so(spark, tmp_path, lateness, total):
    base = 1_700_000_000 // 3600 * 3600
    stream = clicks(spark, tmp_path / "in", [[base, base + 1], [base + 7200, base + 7201], [base + 7300, base + 7301], [base + 3600, base + 3601]])
    counts = windows.window_order_count(stream, size="20 seconds", slide="20 seconds", lateness=lateness)
    out = str(tmp_path / "out")
    query = counts.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(stores.upsert_sink(out, ["window_start", "province_id"])).start()
    query.processAllAvailable()
    query.stop()
    assert stores.read_upserted(spark, out, ["window_start", "province_id"]).agg(F.sum("cnt")).first()[0] == total


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_expiring_counts_in_other_zones(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        base = 1_700_020_800
        stream = clicks(spark, tmp_path / "in", [[base, base + 1], [base + 10], [base + 1000], [base + 2000]])
        counts, seen = state.ad_click_state_expiring_updates(stream, idle="36 seconds"), []
        query = counts.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda df, n: seen.extend(r.click_count for r in df.collect())).start()
        query.processAllAvailable()
        query.stop()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seen == [2, 3, 1, 1]
