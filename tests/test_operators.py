import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates, joins, routing, topn
from tallyloom.plans.area_top_products import area_top10_products

# A hot key holds a third of the rows.
random.seed(5)
PAIRS = [(random.choice(["hot", "hot", "b", "c", "d", "e"]), random.randrange(500)) for _ in range(3000)]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "k string, v int").repartition(6)


def test_group_topn_variants_agree_with_brute_force(pairs):
    groups = defaultdict(list)
    for k, v in PAIRS:
        groups[k].append(v)
    expected = {k: sorted(v, reverse=True)[:3] for k, v in groups.items()}
    plain = topn.group_topn_values(pairs, "k", "v")
    assert {r["k"]: r["top_values"] for r in plain.collect()} == expected
    for salts in (1, 2, 7):
        salted = topn.group_topn_salted(pairs, "k", "v", salts=salts)
        assert {r["k"]: r["top_values"] for r in salted.collect()} == expected


def test_topn_keeps_n_rows_of_a_key_before_the_shuffle(pairs, plan):
    text = plan(topn.group_topn_values(pairs, "k", "v"))
    assert "Partial" in text and "WindowGroupLimit" in text


def test_known_top_values(spark):
    given = {"aa": [78, 97, 80, 69, 78], "bb": [98, 97, 92, 77], "cc": [86, 98, 87, 1]}
    df = spark.createDataFrame([(k, v) for k, vs in given.items() for v in vs], "k string, v int")
    got = {r["k"]: r["top_values"] for r in topn.group_topn_values(df, "k", "v").collect()}
    assert got == {"aa": [97, 80, 78], "bb": [98, 97, 92], "cc": [98, 87, 86]}


def test_overall_order(spark, rows):
    df = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1), ("d", 5)], "word string, cnt int")
    assert [tuple(r) for r in topn.sort_all_desc(df, "cnt", "word").collect()] == [("d", 5), ("b", 2), ("a", 2), ("c", 1)]
    assert rows(topn.bottom_k(df, ["cnt", "word"], 2)) == [("a", 2), ("c", 1)]
    assert rows(topn.top_k(df, ["cnt", "word"], 2)) == [("b", 2), ("d", 5)]
    assert rows(topn.top_k_custom_order(df, F.col("cnt"), "word", 2)) == [("a", 2), ("d", 5)]


def test_group_concat_compares_whole_keys(spark):
    df = spark.createDataFrame([("g", 1, "x"), ("g", 11, "x"), ("g", 1, "x"), ("h", 2, None)], "g string, id int, name string")
    got = aggregates.group_concat_distinct(df, ["g"], "id", "name", "out").collect()
    assert {r["g"]: r["out"] for r in got} == {"g": "1:x:2,11:x:1", "h": "2:null:1"}


def test_conditional_count_keeps_empty_groups(spark, rows):
    df = spark.createDataFrame([("a", ""), ("a", ""), ("a", "5"), ("b", None)], "area string, p string")
    assert rows(aggregates.conditional_count(df, ["area", "p"], "p")) == [("a", "", 0), ("a", "5", 1), ("b", None, 0)]


def test_averages_leave_out_nulls(spark, rows):
    df = spark.createDataFrame([(1, 10.01), (1, 10.02), (1, None), (2, None)], "d int, s double")
    assert rows(aggregates.dept_avg_salary(df, "d", "s")) == [(1, 10.02), (2, None)]
    assert rows(aggregates.avg_udaf(df, "d", "s")) == [(1, pytest.approx(10.015)), (2, None)]


def test_word_counts(spark, rows):
    df = spark.createDataFrame([(" a b  a ",), ("",), ("b",)], "value string")
    assert rows(aggregates.word_count(df)) == [("", 2), ("a", 2), ("b", 2)]
    assert rows(aggregates.word_count(df, drop_blank=True)) == [("a", 2), ("b", 2)]


def test_reports_limit_and_order(spark, rows):
    given = [("x", 60.0)] * 3 + [("y", 60.0)] * 2 + [("z", 60.0)] + [("z", 50.0)]
    df = spark.createDataFrame(given, "u string, a double")
    assert [tuple(r) for r in aggregates.user_order_count(df, "u", "a").collect()] == [("x", 3), ("y", 2)]
    assert rows(aggregates.frequent_ips(df, "u", min_count=2)) == [("x", 3)]
    assert rows(aggregates.sum_rounded(df, "a")) == [(410.0,)]


def test_new_users_count_events(spark, rows):
    given = [
        ("e_l", "u", "1450569600.0", "web", None, "Chrome", "4.5"),
        ("e_l", "u", "1450569600.0", "web", None, "Chrome", "4.6"),
        ("e_l", None, "1450569600.0", "web", None, "Chrome", "4.5"),
        ("e_pv", "u", "1450569600.0", "web", None, "Chrome", "4.5"),
    ]
    df = spark.createDataFrame(given, "en string, u_ud string, s_time string, pl string, ver string, browser string, browser_v string")
    assert rows(aggregates.new_users_by_platform(df)) == [(20, "web:unknown", 2)]
    assert rows(aggregates.new_users_by_platform_browser(df)) == [(20, "web:unknown", "Chrome:4", 2)]


def test_area_report_keeps_unknown_cities(spark, rows):
    visits = spark.createDataFrame(
        [("2017-03-01", "7", 1)] * 3 + [("2017-03-01", "7", 2), ("2017-03-02", "8", 9), ("2017-03-01", " null", 1), ("2017-04-01", "8", 1)],
        "date_part string, click_product_id string, city_id int",
    )
    cities = spark.createDataFrame([(1, "上海", "华东"), (2, "杭州", "华东")], "city_id int, city_name string, area string")
    products = spark.createDataFrame(
        [("7", "seven", '{"product_type":"0"}'), ("8", "eight", '{"product_type":"1"}')],
        "product_id string, product_name string, extend_info string",
    )
    got = area_top10_products(visits, cities, products, start="2017-03-01", end="2017-03-31")
    assert rows(got) == sorted(
        [
            ("华东", "A", "7", "1:上海:3,2:杭州:1", 4, "seven", "自营商品"),
            (None, "E", "8", "9:null:1", 1, "eight", "第三方商品"),
        ],
        key=repr,
    )
    inner = area_top10_products(visits, cities, products, end="2017-03-31", keep_unknown_cities=False)
    assert {r["area"] for r in inner.collect()} == {"华东"}


def test_area_report_filters_at_the_scan(spark, tmp_path, plan):
    df = spark.createDataFrame([("2017-03-01", "7", 1, "x")], "date_part string, click_product_id string, city_id int, other string")
    df.write.partitionBy("date_part").parquet(str(tmp_path / "visits"))
    cities = spark.createDataFrame([(1, "a", "b")], "city_id int, city_name string, area string")
    products = spark.createDataFrame([("7", "p", "{}")], "product_id string, product_name string, extend_info string")
    text = plan(area_top10_products(spark.read.parquet(str(tmp_path / "visits")), cities, products, start="2017-01-01"))
    assert "PartitionFilters: [isnotnull(date_part" in text and "other" not in text


def test_blacklist_filters_agree(spark, rows, plan):
    df = spark.createDataFrame([(i % 50, i) for i in range(500)] + [(None, 1)], "u int, n int")
    black = spark.createDataFrame([(3,), (3,), (7,), (99,)], "u int")
    expected = sorted(((u, n) for u, n in [(i % 50, i) for i in range(500)] + [(None, 1)] if u not in (3, 7)), key=repr)
    assert rows(joins.blacklist_left_outer_filter(df, black, "u")) == expected
    assert rows(joins.blacklist_broadcast_filter(df, black, "u")) == expected
    assert rows(joins.whitelist_exclusion(df, black, "u")) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.blacklist_broadcast_filter(df, black, "u"))
        long_list = joins.blacklist_broadcast_filter(df, black, "u", max_rows=3)
        assert "SortMergeJoin" in plan(long_list) and rows(long_list) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fanout_has_a_row_for_each_visit_and_area(spark):
    visits = spark.createDataFrame([("1", "x")] * 3 + [("2", "x")], "click_product_id string, city string")
    top = spark.createDataFrame([("a", "1", 5), ("b", "1", 4)], "area string, product_id string, click_count int")
    got = joins.top10_fanout_join(visits, top)
    assert Counter(r["area_click_count"] for r in got.collect()) == {5: 3, 4: 3}


def test_routes(spark, tmp_path):
    df = spark.createDataFrame([("alipay",), ("weixin",), ("card",), ("cash",), (None,)], "t string")
    routing.write_routed(routing.route_by_type(df, "t"), str(tmp_path / "r"))
    got = {r["t"]: r["target"] for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert got == {"alipay": "htb_alipay", "weixin": "htb_weixin", "card": "htb_card", "cash": "htb_other", None: "htb_other"}


def test_split_is_repeatable(spark, rows):
    df = spark.range(1000)
    first, second = routing.train_test_split(df), routing.train_test_split(df)
    assert rows(first[0]) == rows(second[0])
    assert first[0].count() + first[1].count() == 1000 and 700 < first[0].count() < 900


def test_cache_is_given_back(spark):
    df = spark.range(10)
    with routing.cache_reused(df) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not df.is_cached
