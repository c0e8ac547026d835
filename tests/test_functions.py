import datetime as dt
import zlib

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, text
from tallyloom.functions.registry import register_functions


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [(None, False), ("", False), (" ", False), ("\t\n", False), ("NULL", False), (" null ", False), ("5", True), ("nullx", True)],
)
def test_is_not_empty(spark, value, expected):
    assert one(spark, value, text.is_not_empty(F.col("v"))) is expected
    register_functions(spark)
    assert one(spark, value, F.expr("isNotEmpty(v)")) is expected


@pytest.mark.parametrize(
    "name, version, platform, browser",
    [
        (None, "1", "unknown:unknown", "unknown:unknown"),
        (" ", "1", "unknown:unknown", "unknown:unknown"),
        ("web", "", "web:unknown", "web:unknown"),
        ("web", None, "web:unknown", "web:unknown"),
        ("web", "1", "web:1", "web:1"),
        ("Chrome", "46.0.1", "Chrome:46.0.1", "Chrome:46"),
    ],
)
def test_dimensions(spark, name, version, platform, browser):
    df = spark.createDataFrame([(name, version)], "n string, v string")
    n, v = F.col("n"), F.col("v")
    assert df.select(text.platform_dimension(n, v)).first()[0] == platform
    assert df.select(text.browser_dimension(n, v)).first()[0] == browser


@pytest.mark.parametrize("uuid, member", [("u1", "m1"), (None, "m1"), ("u1", " "), ("", None), ("用户", "m")])
def test_event_row_key(spark, uuid, member):
    df = spark.createDataFrame([(1450569596500, uuid, member, "e_l")], "t long, u string, m string, a string")
    key = df.select(text.event_row_key(F.col("t"), F.col("u"), F.col("m"), F.col("a"))).first()[0]
    kept = "".join(p for p in (uuid, member) if p and p.strip())
    assert key == f"1450569596500_{zlib.crc32((kept + 'e_l').encode()) % 1_000_000_000}"


def test_event_row_key_variant(spark):
    df = spark.createDataFrame([(5, "u", "m", "e_l")], "t long, u string, m string, a string")
    key = text.event_row_key(F.col("t"), F.col("u"), F.col("m"), F.col("a"), sep="", modulus=10_000_000)
    assert df.select(key).first()[0] == f"5{zlib.crc32(b'ume_l') % 10_000_000}"


def test_small_text_functions(spark):
    assert one(spark, "red;M", text.first_segment(F.col("v"))) == "red"
    assert one(spark, "red", text.first_segment(F.col("v"))) == "red"
    assert one(spark, '{"product_type":"0"}', text.product_type_label(F.col("v"))) == text.OWN_PRODUCT
    assert one(spark, "{}", text.product_type_label(F.col("v"))) == text.THIRD_PARTY_PRODUCT
    assert one(spark, "华东", text.area_level(F.col("v"))) == "A"
    assert one(spark, None, text.area_level(F.col("v"))) == "E"
    assert one(spark, None, text.concat_int_string(F.lit(5), F.col("v"))) == "5:null"


@pytest.mark.parametrize(
    "value, words",
    [("a b", ["a", "b"]), (" a  b ", ["", "a", "b"]), ("", [""]), ("  ", []), ("a\t\n b", ["a", "b"])],
)
def test_split_words(spark, value, words):
    assert one(spark, value, text.split_words(F.col("v"))) == words


def test_splitting_long_white_space_is_fast(spark):
    value = ("x" + " " * 50_000 + "y") * 3
    assert len(one(spark, value, text.split_words(F.col("v")))) == 4


@pytest.mark.parametrize(
    "value, ms", [("1450569596.5", 1450569596500), (" 2 ", 2000), ("x", -1), ("", -1), (None, -1)]
)
def test_server_time(spark, value, ms):
    assert one(spark, value, dates.server_time_to_millis(F.col("v"))) == ms


@pytest.mark.parametrize(
    "value, valid", [("2018-10-08", True), ("2018-99-99", True), ("2018-1-1", False), ("2018-10-08 ", False), (None, False)]
)
def test_is_valid_running_date(spark, value, valid):
    assert one(spark, value, dates.is_valid_running_date(F.col("v"))) is valid


def test_date_text_round_trip(spark):
    df = spark.createDataFrame([("2015-12-20",)], "v string")
    ms = dates.parse_date_string(F.col("v"))
    assert df.select(ms).first()[0] == 1450569600000
    assert df.select(dates.format_date(ms)).first()[0] == "2015-12-20"
    assert df.select(dates.millis_to_string(ms, "yyyy/MM/dd HH:mm:ss", "-60 seconds")).first()[0] == "2015/12/19 23:59:00"


def test_bad_date_text_is_an_error(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("20x5",)], "v string").select(dates.parse_date_string(F.col("v"))).collect()


def test_calendar_against_brute_force(spark):
    days = [dt.date(2014, 12, 20) + dt.timedelta(n) for n in range(1200)]
    day = F.col("d")
    got = spark.createDataFrame([(d,) for d in days], "d date").select(
        day,
        dates.date_part_of(day, "week").alias("week"),
        *[dates.period_starts(day, p).alias(p) for p in ("this_week", "next_week", "previous_month", "next_month")],
    )
    for row in got.collect():
        d = row["d"]
        sunday = d - dt.timedelta((d.weekday() + 1) % 7)
        saturday = sunday + dt.timedelta(6)
        first = dt.date(saturday.year, 1, 1)
        first_sunday = first - dt.timedelta((first.weekday() + 1) % 7)
        assert row["week"] == (sunday - first_sunday).days // 7 + 1, d
        assert row["this_week"] == sunday and row["next_week"] == sunday + dt.timedelta(7)
        assert row["next_month"] == (d.replace(day=1) + dt.timedelta(32)).replace(day=1)
        assert row["previous_month"] == (d.replace(day=1) - dt.timedelta(1)).replace(day=1)


def test_unknown_names_are_errors(spark):
    with pytest.raises(ValueError):
        dates.date_part_of(F.lit(None), "century")
    with pytest.raises(ValueError):
        dates.period_starts(F.lit(None), "last_century")
