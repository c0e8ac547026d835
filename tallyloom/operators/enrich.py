"""Region and user-agent enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tallyloom.functions.text import UNKNOWN, is_blank

# Region names and the defaults for an address without a region.
HOME_COUNTRY = "中国"
DEFAULT_PROVINCE = "上海市"
LOCAL_NETWORK = "局域网"
NO_DATA_PREFIX = "CZ88"
MUNICIPALITIES = ("上海", "北京", "重庆", "天津")
AUTONOMOUS_REGIONS = ("广西", "西藏", "宁夏", "新疆")
INNER_MONGOLIA = "内蒙"
INNER_MONGOLIA_FULL = "内蒙古自治区"
SPECIAL_REGIONS = ("香港", "澳门")
SPECIAL_REGION_SUFFIX = "特别行政区"

# Addresses are joined within blocks of this many leading bits.
BLOCK_BITS = 16


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text to a number; null for other text, also for parts that are not 0 to 255."""
    part = F.split(ip, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        octet = F.get(part, F.lit(i)).try_cast("bigint")
        number = number * 256 + F.when(octet.between(0, 255), octet)
    return F.when(F.size(part) == 4, number)


def region_columns(area: Column) -> dict[str, Column]:
    """Country, province and city out of the text of an address range."""
    no_data = is_blank(area) | (area == LOCAL_NETWORK) | F.ltrim(area).startswith(NO_DATA_PREFIX)
    two = F.substring(area, 1, 2)
    in_province = area.rlike("^[^省]+省")
    home = in_province | two.isin(
        INNER_MONGOLIA, *AUTONOMOUS_REGIONS, *MUNICIPALITIES, *SPECIAL_REGIONS
    )
    found = lambda pattern, text: F.coalesce(
        F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), F.lit(UNKNOWN)
    )
    after = lambda n: F.substr(area, F.lit(n + 1))
    district = F.nullif(F.regexp_extract(after(3), "^([^区]+区)", 1), F.lit(""))
    country = (
        F.when(no_data | home, HOME_COUNTRY)
        .when(F.length(area) < 2, UNKNOWN)
        .otherwise(area)
    )
    province = (
        F.when(no_data, DEFAULT_PROVINCE)
        .when(in_province, found("^([^省]+省)", area))
        .when(two == INNER_MONGOLIA, INNER_MONGOLIA_FULL)
        .when(two.isin(*AUTONOMOUS_REGIONS), two)
        .when(two.isin(*MUNICIPALITIES), F.concat(two, F.lit("市")))
        .when(two.isin(*SPECIAL_REGIONS), F.concat(two, F.lit(SPECIAL_REGION_SUFFIX)))
        .otherwise(UNKNOWN)
    )
    city = (
        F.when(no_data, UNKNOWN)
        .when(in_province, found("^[^省]+省([^市]*市)", area))
        .when(two == INNER_MONGOLIA, found("^([^市]+市)", after(3)))
        .when(two.isin(*AUTONOMOUS_REGIONS), found("^([^市]+市)", after(2)))
        .when(
            two.isin(*MUNICIPALITIES),
            F.coalesce(district, found("^([^县]+县)", after(3))),
        )
        .otherwise(UNKNOWN)
    )
    return {"country": country, "province": province, "city": city}


def enrich_region(df: DataFrame, ip: str, ranges: DataFrame) -> DataFrame:
    """Add country, province and city by the address range that holds ``ip``.

    ``ranges`` has ``lo``, ``hi`` (numbers, ends included, not overlapping) and
    ``area``.  A range is listed once for each block of addresses it touches,
    at most 65,536 of them, and an address looks only at its own block: an
    equi join with a range condition.  An address finds one range at most, so
    no row is repeated, and one without a range gets the defaults.
    Addresses that cannot be read find no block, and
    are dealt by the row instead of meeting in one task.
    """
    width = 1 << (32 - BLOCK_BITS)
    block = lambda c: F.floor(c / width).cast("bigint")
    # The texts are taken apart on the side of the ranges, which are few.
    named = ranges.select("lo", "hi", *[c.alias(f"_{n}") for n, c in region_columns(F.col("area")).items()])
    listed = named.withColumn("_block", F.explode(F.sequence(block(F.col("lo")), block(F.col("hi")))))
    listed = listed.withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    nowhere = -1 - F.pmod(F.xxhash64(*plain), F.lit(4096))
    keyed = df.withColumn("_n", ip_to_long(F.col(ip))).withColumn("_at", F.coalesce(block(F.col("_n")), nowhere))
    inside = (
        (F.col("_at") == F.col("_block"))
        & (F.col("_lo") <= F.col("_n"))
        & (F.col("_n") <= F.col("_hi"))
    )
    defaults = {"country": HOME_COUNTRY, "province": DEFAULT_PROVINCE, "city": UNKNOWN}
    return (
        keyed.join(listed, inside, "left")
        .withColumns({n: F.coalesce(f"_{n}", F.lit(default)) for n, default in defaults.items()})
        .drop("_n", "_at", "_lo", "_hi", "_block", *[f"_{n}" for n in defaults])
    )


# Fixed values: (name, pattern with the version as its group), tried in this order.
BROWSER_RULES = (
    ("Edge", r"Edge?/([0-9.]+)"),
    ("Opera", r"(?:OPR|Opera)/([0-9.]+)"),
    ("IE", r"MSIE ([0-9.]+)"),
    ("IE", r"Trident/.*rv:([0-9.]+)"),
    ("Firefox", r"Firefox/([0-9.]+)"),
    ("Chrome", r"Chrome/([0-9.]+)"),
    ("Safari", r"Version/([0-9.]+).*Safari"),
)
# (family, pattern, version label)
OS_RULES = (
    ("Windows", r"Windows NT 10\.0", "Windows 10"),
    ("Windows", r"Windows NT 6\.3", "Windows 8.1"),
    ("Windows", r"Windows NT 6\.2", "Windows 8"),
    ("Windows", r"Windows NT 6\.1", "Windows 7"),
    ("Windows", r"Windows NT 6\.0", "Windows Vista"),
    ("Windows", r"Windows NT 5\.1", "Windows XP"),
    ("Windows", r"Windows", "Windows"),
    ("iOS", r"iPhone|iPad", "iOS"),
    ("Android", r"Android", "Android"),
    ("OS X", r"Mac OS X", "OS X"),
    ("Linux", r"Linux", "Linux"),
)


def enrich_user_agent(
    df: DataFrame,
    ua: str,
    rules: Sequence[tuple[str, str]] = BROWSER_RULES,
    os_rules: Sequence[tuple[str, str, str]] = OS_RULES,
) -> DataFrame:
    """Add browser, browser_v, os and os_v; null where no rule fits.

    Name and version come from one chain of tests, which ends at the first hit.
    """
    text = F.col(ua)

    def first(hits: list[tuple[str, Column]]) -> Column:
        chain = None
        for pattern, hit in hits:
            chain = (F if chain is None else chain).when(text.rlike(pattern), hit)
        return chain

    browser = [
        (p, F.struct(F.lit(n).alias("name"), F.regexp_extract(text, p, 1).alias("version"))) for n, p in rules
    ]
    system = [(p, F.struct(F.lit(n).alias("name"), F.lit(v).alias("version"))) for n, p, v in os_rules]
    return (
        df.withColumns({"_browser": first(browser), "_os": first(system)})
        .withColumns(
            {
                "browser": F.col("_browser.name"),
                "browser_v": F.col("_browser.version"),
                "os": F.col("_os.name"),
                "os_v": F.col("_os.version"),
            }
        )
        .drop("_browser", "_os")
    )
