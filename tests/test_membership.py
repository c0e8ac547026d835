"""The filter of a list, and lists that are too long to be sent whole."""

from pyspark.sql import functions as F

from tallyloom.operators.joins import blacklist_broadcast_filter
from tallyloom.operators.membership import may_be_listed, membership_anti_join, membership_bits, merged_bits
from tallyloom.sinks import stores


def test_nothing_listed_is_missed(spark):
    listed = spark.range(0, 20_000, 3).withColumnRenamed("id", "user_id")
    df = spark.range(40_000).withColumnRenamed("id", "user_id").unionByName(spark.createDataFrame([(None,)], "user_id long"))
    parts = [membership_bits(listed.where(F.col("user_id") % 2 == n), "user_id", blocks=16) for n in (0, 1)]
    bits = merged_bits(parts[0].unionByName(parts[1]))
    assert bits.count() <= 16
    asked = may_be_listed(df, "user_id", bits, "maybe", blocks=16)
    assert asked.count() == 40_001
    assert asked.join(listed, "user_id").where("NOT maybe").count() == 0
    wrong = asked.join(listed, "user_id", "left_anti").where("maybe").count()
    assert wrong < 0.05 * 33_333
    assert asked.where("user_id IS NULL AND maybe").count() == 0


def test_the_same_rows_as_an_anti_join(spark, rows, plan):
    listed = spark.createDataFrame([(i,) for i in (1, 5, 5, 7, None)], "user_id long")
    df = spark.createDataFrame([(i % 9, i, "x") for i in range(50)] + [(None, 99, "x")], "user_id long, n long, _block string")
    bits = membership_bits(listed, "user_id")
    expected = rows(df.join(listed, "user_id", "left_anti").select("user_id", "n"))
    assert rows(membership_anti_join(df.drop("_block"), listed, "user_id", bits)) == expected
    assert rows(blacklist_broadcast_filter(df.drop("_block"), listed, "user_id", 2, bits)) == expected
    empty = listed.where("false")
    assert membership_anti_join(df.drop("_block"), empty, "user_id", membership_bits(empty, "user_id")).count() == 51


def test_a_filter_that_grows(spark, tmp_path):
    path = str(tmp_path)
    assert stores.read_bits(spark, path).count() == 0
    write = stores.bits_sink(path, "user_id", fan_in=2)
    for n in range(5):
        write(spark.createDataFrame([(n,), (100 + n,)], "user_id long"), n)
    asked = may_be_listed(spark.range(110).withColumnRenamed("id", "user_id"), "user_id", stores.read_bits(spark, path), "maybe")
    found = {r.user_id for r in asked.where("maybe").collect()}
    assert {0, 1, 2, 3, 4, 100, 101, 102, 103, 104} <= found and len(found) < 20
