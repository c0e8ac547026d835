"""Text, JSON and dimension expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and codes that results must carry.
UNKNOWN = "unknown"
AREA_LEVELS = {
    "华东": "A",
    "华南": "A",
    "华北": "A",
    "东北": "B",
    "华中": "C",
    "西南": "C",
    "西北": "D",
}
OTHER_AREA_LEVEL = "E"
OWN_PRODUCT = "自营商品"
THIRD_PARTY_PRODUCT = "第三方商品"
ROW_KEY_MODULUS = 1_000_000_000


def is_blank(text: Column) -> Column:
    """Null, empty or white space only; never null itself."""
    return ~F.coalesce(text.rlike(r"\S"), F.lit(False))


_TRIMMED = "".join(chr(code) for code in range(0x21))


def is_not_empty(text: Column) -> Column:
    """Not null, not blank, and not the word ``null`` in any case."""
    trimmed = F.lower(F.btrim(text.cast("string"), F.lit(_TRIMMED)))
    return F.coalesce(~trimmed.isin("", "null"), F.lit(False))


def concat_int_string(number: Column, text: Column) -> Column:
    """``id:name``; a missing name shows as the word null, a missing id gives null."""
    return F.concat(number.cast("string"), F.lit(":"), F.coalesce(text, F.lit("null")))


def json_string_field(json: Column, field: str) -> Column:
    return F.get_json_object(json, f"$.{field}")


def area_level(
    area: Column,
    mapping: Mapping[str, str] = AREA_LEVELS,
    default: str = OTHER_AREA_LEVEL,
) -> Column:
    level = None
    for name, code in mapping.items():
        level = (F if level is None else level).when(area == name, code)
    return F.lit(default) if level is None else level.otherwise(default)


def product_type_label(
    json: Column,
    own: str = OWN_PRODUCT,
    third_party: str = THIRD_PARTY_PRODUCT,
    field: str = "product_type",
) -> Column:
    return F.when(json_string_field(json, field) == "0", own).otherwise(third_party)


def first_segment(text: Column, sep: str = ";") -> Column:
    """The text before the first separator."""
    return F.substring_index(text, sep, 1)


def platform_dimension(name: Column, version: Column) -> Column:
    return (
        F.when(is_blank(name), f"{UNKNOWN}:{UNKNOWN}")
        .when(is_blank(version), F.concat(name, F.lit(f":{UNKNOWN}")))
        .otherwise(F.concat(name, F.lit(":"), version))
    )


def browser_dimension(name: Column, version: Column) -> Column:
    """As the platform, but with the major version only."""
    major = F.when(is_blank(version), version).otherwise(F.substring_index(version, ".", 1))
    return (
        F.when(is_blank(name), f"{UNKNOWN}:{UNKNOWN}")
        .when(is_blank(version), F.concat(name, F.lit(f":{UNKNOWN}")))
        .otherwise(F.concat(name, F.lit(":"), major))
    )


def event_row_key(
    time_ms: Column,
    uuid: Column,
    member: Column,
    alias: Column,
    sep: str = "_",
    modulus: int = ROW_KEY_MODULUS,
) -> Column:
    """``millis_crc``, the crc taken over the parts that are not blank."""
    kept = [F.when(is_blank(part), F.lit("")).otherwise(part) for part in (uuid, member)]
    crc = F.crc32(F.concat(*kept, F.coalesce(alias, F.lit(""))).cast("binary")) % modulus
    return F.concat_ws(sep, time_ms.cast("string"), crc.cast("string"))


WHITE_SPACE = " \t\n\x0b\f\r"


def split_trimmed(text: Column, separator: str) -> Column:
    """Split at every ``separator``, one character, and leave out empty parts at the end."""
    return F.split(F.rtrim(text, F.lit(separator)), rf"\{separator}")


def split_words(text: Column) -> Column:
    """Split at white space.

    White space in front gives one empty word, an empty text is one empty
    word, and a text of white space has no words.
    """
    trimmed = F.rtrim(text, F.lit(WHITE_SPACE))
    blank = F.when(text == "", F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(trimmed == "", blank).otherwise(F.split(trimmed, r"\s+"))
