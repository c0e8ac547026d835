"""File sources: text, delimited, JSON, parquet and document collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import split_words


def read_text_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``key value``, split at white space; lines without a number there are left out."""
    parts = split_words(F.col("value"))
    return (
        spark.read.text(path)
        .select(parts.alias("p"))
        .filter(F.size("p") >= 2)
        .select(F.col("p")[0].alias("key"), F.col("p")[1].try_cast("int").alias("value"))
        .filter("value IS NOT NULL")
    )


def read_delimited(
    spark: SparkSession, path: str, sep: str = "\t", header: bool = True, infer: bool = True
) -> DataFrame:
    """Delimited text; inferring the types costs one more pass over the files."""
    return spark.read.options(sep=sep, header=header, inferSchema=infer).csv(path)


def read_delimited_schema(
    spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = False
) -> DataFrame:
    """Delimited text with declared types: no inference pass."""
    return spark.read.schema(schema).options(sep=sep, header=header).csv(path)


def read_multichar_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = "::"
) -> DataFrame:
    """A separator of several characters goes to the reader as it is."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: str | None = None, sampling: float = 1.0
) -> DataFrame:
    """JSON lines; without a schema Spark infers it from ``sampling`` of the rows."""
    reader = spark.read.option("samplingRatio", sampling) if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_document_store(
    spark: SparkSession, uri: str, collection: str, schema: str, fmt: str = "json"
) -> DataFrame:
    """A document collection with a declared schema.

    ``json`` and other file formats read the folder ``uri/collection``; any
    other format name is taken as a connector and is given both as options.
    """
    reader = spark.read.format(fmt).schema(schema)
    if fmt in ("json", "parquet", "orc"):
        return reader.load(f"{uri.rstrip('/')}/{collection}")
    return reader.options(uri=uri, collection=collection).load()


def scan_columns_filter(df: DataFrame, columns: list[str], column: str, value: str) -> DataFrame:
    """Some columns of the rows where one column has a value.

    Both reach the scan: the columns as its read schema, the comparison as a pushed filter.
    """
    return df.filter(F.col(column) == value).select(*columns)
