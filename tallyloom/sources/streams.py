"""Streaming sources.  Format and options are parameters: the same code reads files or a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FILE_FORMATS = ("text", "json", "csv", "parquet", "orc")


def stream_text_source(
    spark: SparkSession, fmt: str = "text", options: dict[str, str] | None = None
) -> DataFrame:
    """Lines as a stream with one column ``value``, e.g. ``text`` with ``path`` or ``socket``."""
    return spark.readStream.format(fmt).options(**(options or {})).load()


def stream_topic_source(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str] | None = None,
    max_per_trigger: int | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A topic as a stream; ``max_per_trigger`` caps what one batch takes.

    The cap counts files for a file format and offsets for a broker.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema:
        reader = reader.schema(schema)
    if max_per_trigger:
        cap = "maxFilesPerTrigger" if fmt in FILE_FORMATS else "maxOffsetsPerTrigger"
        reader = reader.option(cap, max_per_trigger)
    return reader.load()


def stream_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both inputs in one, matched by column name; equal rows stay."""
    return a.unionByName(b)
