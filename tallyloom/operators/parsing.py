"""Log and message lines to typed columns.  Rows that do not fit are left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.text import WHITE_SPACE, split_trimmed, split_words

# The line formats and event names that inputs follow.
ACCESS_LOG_PATTERN = (
    r'^(\S+) (-|\S+) (-|\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+)$'
)
EVENT_LOG_SEPARATOR = r"\^A"
EVENT_ALIASES = ("e_l", "e_pv", "e_crt", "e_cs", "e_cr", "e_e")

ACCESS_LOG_COLUMNS = (
    "ip_address",
    "client_ident",
    "user_id",
    "date_time",
    "method",
    "endpoint",
    "protocol",
    "response_code",
    "content_size",
)


def _kept(fits: Column, row: Column) -> Column:
    """``row`` where it fits, by exploding it into itself.

    A filter after a parsing projection is moved in front of it by Spark and
    parses every line a second time; this way a line is parsed once.
    """
    return F.explode(F.when(fits, F.array(row)))


def parse_access_log(df: DataFrame, col: str = "value") -> DataFrame:
    """Common log format to nine columns.

    The pattern runs once for a line: its groups become one text with line
    feeds in between.  The date is put last: it alone may hold white space.
    A line that does not match stays as it is, and one that does gets shorter.
    """
    apart = F.regexp_replace(col, ACCESS_LOG_PATTERN, "$1\n$2\n$3\n$5\n$6\n$7\n$8\n$9\n$4")
    part = F.col("_part")
    return (
        df.select(F.col(col).alias("_line"), apart.alias("_apart"))
        .select(_kept(F.col("_apart") != F.col("_line"), F.split("_apart", "\n", 9)).alias("_part"))
        .select(
            part[0].alias("ip_address"),
            part[1].alias("client_ident"),
            part[2].alias("user_id"),
            part[8].alias("date_time"),
            part[3].alias("method"),
            part[4].alias("endpoint"),
            part[5].alias("protocol"),
            part[6].cast("int").alias("response_code"),
            part[7].try_cast("bigint").alias("content_size"),
        )
    )


def parse_access_log_split(df: DataFrame, col: str = "value") -> DataFrame:
    """The same columns from a line of exactly ten words; the date has no zone."""
    words, part = F.col("_words"), F.col("_part")
    bare = lambda c, mark: F.replace(c, F.lit(mark), F.lit(""))
    return (
        df.select(split_words(F.col(col)).alias("_words"))
        .select(_kept(F.size(words) == 10, words).alias("_part"))
        .select(
            part[0].alias("ip_address"),
            part[1].alias("client_ident"),
            part[2].alias("user_id"),
            bare(part[3], "[").alias("date_time"),
            bare(part[5], '"').alias("method"),
            part[6].alias("endpoint"),
            bare(part[7], '"').alias("protocol"),
            part[8].try_cast("int").alias("response_code"),
            part[9].try_cast("bigint").alias("content_size"),
        )
        .filter(F.col("response_code").isNotNull() & F.col("content_size").isNotNull())
    )


def parse_orders_csv(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``order,province,price`` and possibly more fields; ``keep`` names columns to carry along."""
    fields, part = F.col("_fields"), F.col("_part")
    return (
        df.select(*keep, split_trimmed(F.trim(F.col(col)), ",").alias("_fields"))
        .select(*keep, _kept(F.size(fields) >= 3, fields).alias("_part"))
        .select(
            *keep,
            part[0].alias("order_id"),
            part[1].try_cast("int").alias("province_id"),
            part[2].try_cast("double").alias("order_price"),
        )
    )


def parse_orders_json(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    read, order = F.col("_read"), F.col("_order")
    return (
        df.select(*keep, F.from_json(col, schemas.ORDER_JSON).alias("_read"))
        .select(*keep, _kept(read["orderId"].isNotNull(), read).alias("_order"))
        .select(
            *keep,
            order["orderId"].alias("order_id"),
            order["provinceId"].alias("province_id"),
            order["orderPrice"].alias("order_price"),
        )
    )


def parse_ad_clicks(df: DataFrame, col: str = "value", exact: bool = True) -> DataFrame:
    """``millis province city user ad``, separated by blanks.

    ``exact`` wants five words, no more; otherwise words after the fifth are ignored.
    Rows whose time, user or ad is no number are left out.
    """
    words, part = F.col("_words"), F.col("_part")
    parts = F.transform(F.split(F.col(col), " "), lambda w: F.trim(w))
    size = F.size(words)
    numbers = F.lit(True)
    for i in (0, 3, 4):
        numbers &= F.get(words, F.lit(i)).try_cast("bigint").isNotNull()
    return (
        df.select(F.filter(parts, lambda w: w != "").alias("_words"))
        .select(_kept((size == 5 if exact else size >= 5) & numbers, words).alias("_part"))
        .select(
            part[0].cast("bigint").alias("ts_ms"),
            part[1].alias("province"),
            part[2].alias("city"),
            part[3].cast("bigint").alias("user_id"),
            part[4].cast("bigint").alias("ad_id"),
        )
    )


def _decoded(value: Column) -> Column:
    """The value of ``k=value``, or null if there is none; most values need no decoding."""
    bare = F.substring_index(value, "=", 1)
    coded = value.contains("%") | value.contains("+")
    return F.when(value != "", F.when(coded, F.try_url_decode(bare)).otherwise(bare))


def parse_event_log(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``ip^Aseconds^Ahost^A/path?k=v&…`` to a map column ``fields``.

    The map holds ``ip``, ``s_time``, ``http_host`` and the decoded query
    fields; of a repeated key the last value counts.  The path must hold one
    question mark with text on both sides, otherwise it gives no fields.

    Every step is a projection of its own, so what it makes is made once,
    however often the next one uses it.
    """
    part, halves, tidy, keys, ranked = (F.col(c) for c in ("_part", "_halves", "_tidy", "_keys", "_ranked"))
    # The head fields come first, so that a query field of the same name replaces them.
    heads = [F.concat(F.lit(f"{n}="), F.url_encode(part[i])) for i, n in enumerate(("ip", "s_time", "http_host"))]
    # Empty parts at the end do not count.
    four_parts = (F.get(part, F.lit(3)) != "") & (F.array_join(F.slice(part, 5, F.size(part)), "") == "")
    repeated = F.size(keys) != F.size(F.array_distinct(keys))
    # Of equal keys, which lie side by side once sorted, the one that came last in the line.
    entry = lambda e, i: F.struct(F.substring_index(e, "=", 1).alias("k"), (-i).alias("i"), e.alias("e"))
    first_of_key = lambda x, i: (i == 0) | (F.get(ranked, i - 1)["k"] != x["k"])
    last = F.array_join(F.transform(F.filter(ranked, first_of_key), lambda x: x["e"]), "&")
    pairs = F.transform_values(F.str_to_map("_pairs", F.lit("&"), F.lit("=")), lambda k, v: _decoded(v))
    return (
        df.select(*keep, F.split(F.col(col), EVENT_LOG_SEPARATOR).alias("_part"))
        .select(
            *keep,
            four_parts.alias("_fits"),
            F.when(F.size(part) >= 3, F.concat_ws("&", *heads)).alias("_heads"),
            split_trimmed(F.get(part, F.lit(3)), "?").alias("_halves"),
        )
        .select(*keep, "_fits", F.concat_ws("&", "_heads", F.when(F.size(halves) == 2, halves[1])).alias("_joined"))
        .select(*keep, "_fits", F.regexp_replace(F.btrim("_joined", F.lit("&")), "&&+", "&").alias("_tidy"))
        .select(*keep, "_fits", "_tidy", F.split(F.regexp_replace(tidy, "=[^&]*", ""), "&").alias("_keys"))
        .select(*keep, "_fits", "_tidy", F.when(repeated, F.array_sort(F.transform(F.split(tidy, "&"), entry))).alias("_ranked"))
        .select(*keep, "_fits", F.when(ranked.isNotNull(), last).otherwise(tidy).alias("_pairs"))
        .select(*keep, _kept(F.col("_fits"), pairs).alias("fields"))
    )


def filter_event_types(
    df: DataFrame, col: str = "en", aliases: Sequence[str] = EVENT_ALIASES
) -> DataFrame:
    """Rows of the known event types."""
    return df.filter(F.col(col).isin(list(aliases)))


def tokenize_lowercase(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    """Words in lower case without commas and full stops.

    A word of nothing but those marks stays as an empty word, so the white
    space becomes single blanks before the marks go.
    """
    text = F.col(col)
    single = F.regexp_replace(F.rtrim(text, F.lit(WHITE_SPACE)), r"\s+", " ")
    words = F.split(F.translate(F.lower(single), ",.", ""), " ")
    no_words = F.array().cast("array<string>")
    return df.withColumn(out, F.when(text.rlike(r"\S") | (text == ""), words).otherwise(no_words))


def optional_date_range(
    df: DataFrame, col: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Days from ``start`` to ``end``, both included; a limit that is not given does not apply.

    The bare column is compared, so partitions and row groups can be pruned.
    """
    if start:
        df = df.filter(F.col(col) >= start)
    if end:
        df = df.filter(F.col(col) <= end)
    return df


def project_filter_sort(df: DataFrame, cols: list[str], predicate: Column | str, order: list[Column]) -> DataFrame:
    return df.filter(predicate).select(*cols).orderBy(*order)
