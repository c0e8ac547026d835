"""Functions for SQL text.

They are SQL functions, so Catalyst puts their body in place of the call and
no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "isNotEmpty": (
        "s STRING",
        "BOOLEAN",
        r"coalesce(s RLIKE '[^\\x00-\\x20]' AND NOT s RLIKE '(?i)\\A[\\x00-\\x20]*null[\\x00-\\x20]*\\z', false)",
    ),
    "concat_int_string": (
        "id BIGINT, name STRING",
        "STRING",
        "concat(CAST(id AS STRING), ':', coalesce(name, 'null'))",
    ),
    "get_string_from_json": (
        "json STRING, field STRING",
        "STRING",
        "get_json_object(json, concat('$.', field))",
    ),
    "parse_extend_info": (
        "json STRING",
        "INT",
        "coalesce(try_cast(get_json_object(json, '$.productTypeId') AS INT), 0)",
    ),
    "first_segment": (
        "s STRING, sep STRING",
        "STRING",
        "substring_index(s, sep, 1)",
    ),
    "get_bra_color": (
        "size_info STRING",
        "STRING",
        "substring_index(size_info, ';', 1)",
    ),
    "area_level": (
        "area STRING",
        "STRING",
        "CASE WHEN area IN ('华东', '华南', '华北') THEN 'A' WHEN area = '东北' THEN 'B' "
        "WHEN area IN ('华中', '西南') THEN 'C' WHEN area = '西北' THEN 'D' ELSE 'E' END",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to ``spark.sql``; returns their names."""
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}"
        )
    return list(SQL_FUNCTIONS)
