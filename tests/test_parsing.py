import pytest
from pyspark.sql import functions as F

from tallyloom.operators import enrich, parsing
from tallyloom.plans.event_log import clean_events, load_events, new_users

GOOD = '64.242.88.10 - - [07/Mar/2004:16:47:12 -0800] "GET /robots.txt HTTP/1.1" 200 68'


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_access_log(spark, rows):
    bad = [GOOD[:-2] + "-", GOOD.replace('"GET', "GET"), "", GOOD + " x", None]
    parsed = rows(parsing.parse_access_log(lines(spark, GOOD, *bad)))
    assert parsed == [
        ("64.242.88.10", "-", "-", "07/Mar/2004:16:47:12 -0800", "GET", "/robots.txt", "HTTP/1.1", 200, 68)
    ]


def test_access_log_by_words(spark, rows):
    bad = [GOOD[:-2] + "-", GOOD + " x", GOOD.replace("200", "2x0"), ""]
    parsed = rows(parsing.parse_access_log_split(lines(spark, GOOD, *bad)))
    assert parsed == [("64.242.88.10", "-", "-", "07/Mar/2004:16:47:12", "GET", "/robots.txt", "HTTP/1.1", 200, 68)]


def test_orders_csv(spark, rows):
    parsed = parsing.parse_orders_csv(lines(spark, " a,1,2.5 ", "b,2,3,x,,", "c,3,", "c,,", " ", "d,x,1"))
    assert rows(parsed) == [("a", 1, 2.5), ("b", 2, 3.0), ("d", None, 1.0)]


def test_orders_json(spark, rows):
    parsed = parsing.parse_orders_json(lines(spark, '{"orderId":"a","provinceId":1,"orderPrice":2.5}', "{bad"))
    assert rows(parsed) == [("a", 1, 2.5)]


def test_ad_clicks(spark, rows):
    given = lines(spark, "1 p c 2 3", "1  p  c 4 5 ", "1 p c 6", "1 p c 7 8 9", "")
    assert rows(parsing.parse_ad_clicks(given)) == [(1, "p", "c", 2, 3), (1, "p", "c", 4, 5)]
    assert len(rows(parsing.parse_ad_clicks(given, exact=False))) == 3


@pytest.mark.parametrize(
    "line, fields",
    [
        ("1.1^A5^Ah^A/x?en=e_l&u=a%20b", {"ip": "1.1", "s_time": "5", "http_host": "h", "en": "e_l", "u": "a b"}),
        ("1.1^A5^Ah^A/x?a=1&a=2&b=3&a=4", {"ip": "1.1", "s_time": "5", "http_host": "h", "a": "4", "b": "3"}),
        ("1.1^A5^Ah^A/x?ip=9&aa=1&a=2", {"ip": "9", "s_time": "5", "http_host": "h", "aa": "1", "a": "2"}),
        ("1.1^A5^Ah^A/x?a=1=2&b&c=", {"ip": "1.1", "s_time": "5", "http_host": "h", "a": "1", "b": None, "c": None}),
        ("1.1^A5^Ah^A/x?a=1&&b=2&", {"ip": "1.1", "s_time": "5", "http_host": "h", "a": "1", "b": "2"}),
        ("1.1^A5^Ah^A/x", {"ip": "1.1", "s_time": "5", "http_host": "h"}),
        ("1.1^A5^Ah^A/x?a=1?b=2", {"ip": "1.1", "s_time": "5", "http_host": "h"}),
        ("a=1&b^A5^Ah^A/x", {"ip": "a=1&b", "s_time": "5", "http_host": "h"}),
        ("1.1^A5^A/x?a=1", None),
        ("", None),
        (None, None),
    ],
)
def test_event_log(spark, line, fields):
    got = parsing.parse_event_log(lines(spark, line)).collect()
    assert [r["fields"] for r in got] == ([] if fields is None else [fields])


def test_tokens_keep_words_of_marks_only(spark):
    got = parsing.tokenize_lowercase(lines(spark, "Fed, says .  U.S. weak", ",", "  ", ""), "value").collect()
    assert [r["words"] for r in got] == [["fed", "says", "", "us", "weak"], [""], [], [""]]


def test_date_range_limits_are_optional(spark, rows):
    df = lines(spark, "2017-03-01", "2017-03-20", "2017-04-01")
    assert len(rows(parsing.optional_date_range(df, "value"))) == 3
    assert len(rows(parsing.optional_date_range(df, "value", start="2017-03-20"))) == 2
    assert len(rows(parsing.optional_date_range(df, "value", "2017-03-02", "2017-03-20"))) == 1


AREAS = [
    ("浙江省杭州市", ("中国", "浙江省", "杭州市")),
    ("浙江省", ("中国", "浙江省", "unknown")),
    ("内蒙古包头市", ("中国", "内蒙古自治区", "包头市")),
    ("广西桂林市", ("中国", "广西", "桂林市")),
    ("新疆", ("中国", "新疆", "unknown")),
    ("上海市浦东新区", ("中国", "上海市", "浦东新区")),
    ("重庆市城口县", ("中国", "重庆市", "城口县")),
    ("北京", ("中国", "北京市", "unknown")),
    ("香港", ("中国", "香港特别行政区", "unknown")),
    ("美国", ("美国", "unknown", "unknown")),
    ("局域网", ("中国", "上海市", "unknown")),
    (" CZ88.NET", ("中国", "上海市", "unknown")),
    ("x", ("unknown", "unknown", "unknown")),
    (None, ("中国", "上海市", "unknown")),
]


@pytest.mark.parametrize("area, expected", AREAS)
def test_region_text(spark, area, expected):
    df = spark.createDataFrame([(area,)], "a string").select(*enrich.region_columns(F.col("a")).values())
    assert tuple(df.first()) == expected


def test_region_ranges_against_brute_force(spark):
    ranges = [(10 << 24, (10 << 24) + 200_000, "浙江省"), ((10 << 24) + 200_001, (10 << 24) + 200_001, "广西"), (5, 9, "美国")]
    ips = ["10.0.0.0", "10.3.13.64", "10.3.13.65", "10.3.13.66", "0.0.0.7", "0.0.0.4", "bad", None, "1.2.3", "10.0.0.0"]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "n int, ip string")
    got = enrich.enrich_region(df, "ip", spark.createDataFrame(ranges, "lo long, hi long, area string"))
    found = {r["n"]: r["province"] if r["country"] == "中国" else r["country"] for r in got.collect()}

    def expected(ip):
        try:
            a, b, c, d = (int(p) for p in ip.split("."))
        except (ValueError, AttributeError):
            return "上海市"
        n = ((a * 256 + b) * 256 + c) * 256 + d
        return next((area for lo, hi, area in ranges if lo <= n <= hi), "上海市")

    assert found == {i: expected(ip) for i, ip in enumerate(ips)}


def test_user_agents(spark, rows):
    agents = lines(
        spark,
        "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 Chrome/46.0.1 Safari/537.36",
        "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1)",
        "curl",
        None,
    )
    got = rows(enrich.enrich_user_agent(agents, "value").drop("value"))
    assert got == sorted(
        [("Chrome", "46.0.1", "Windows", "Windows 7"), ("IE", "8.0", "Windows", "Windows XP"), (None,) * 4, (None,) * 4],
        key=repr,
    )


def test_event_log_job(spark, tmp_path, rows):
    agent = "b_iev=Mozilla%2F5.0%20(Windows%20NT%206.1)%20Chrome%2F46.0.1"
    given = lines(
        spark,
        f"10.0.0.1^A1450569596.5^Ah^A/x?en=e_l&u_ud=u1&pl=website&ver=1&{agent}",
        f"10.0.0.1^A1450569597.5^Ah^A/x?en=e_l&u_ud=u1&pl=website&ver=1&{agent}",
        "10.0.0.1^A1450569598.5^Ah^A/x?en=e_l&u_ud=u2",
        "10.0.0.1^A1450569599.5^Ah^A/x?en=e_pv&u_ud=u2",
        "10.0.0.1^A1450569599.5^Ah^A/x?en=nonsense&u_ud=u2",
        "broken",
    )
    ranges = spark.createDataFrame([(10 << 24, (10 << 24) + 9, "浙江省杭州市")], "lo long, hi long, area string")
    events = clean_events(given, ranges)
    assert {r["fields"]["city"] for r in events.collect()} == {"杭州市"}
    assert events.count() == 4
    for _ in range(2):
        path = load_events(given, str(tmp_path), "2015-12-20", ranges)
    assert path.endswith("event_logs20151220")
    assert rows(new_users(spark, path)) == sorted(
        [
            (19, "website:1", "Chrome:46", 2),
            (19, "website:1", None, 2),
            (19, "unknown:unknown", "unknown:unknown", 1),
            (19, "unknown:unknown", None, 1),
        ],
        key=repr,
    )
