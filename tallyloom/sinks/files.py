"""File, document and relational sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _bounded(df: DataFrame, max_writers: int | None) -> DataFrame:
    """At most ``max_writers`` tasks write; a shuffle keeps the work before it parallel."""
    return df.repartition(max_writers) if max_writers else df


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, max_writers: int | None = None) -> None:
    _bounded(df, max_writers).write.mode("overwrite").options(sep=sep, header=header).csv(path)


def write_text(df: DataFrame, path: str, max_writers: int | None = None) -> None:
    """``df`` has one string column."""
    _bounded(df, max_writers).write.mode("overwrite").text(path)


def document_sink(df: DataFrame, uri: str, collection: str, fmt: str = "json") -> None:
    """Replace a document collection; formats as in ``read_document_store``."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt in ("json", "parquet", "orc"):
        writer.save(f"{uri.rstrip('/')}/{collection}")
    else:
        writer.options(uri=uri, collection=collection).save()


def _jdbc(df: DataFrame, url: str, table: str, props: dict[str, str] | None, mode: str, batch: int, max_writers: int):
    options = {"batchsize": str(batch), "numPartitions": str(max_writers), **(props or {})}
    _bounded(df, max_writers).write.mode(mode).jdbc(url, table, properties=options)


def write_jdbc_append(
    df: DataFrame, url: str, table: str, props: dict[str, str] | None = None, max_writers: int = 8
) -> None:
    _jdbc(df, url, table, props, "append", 1000, max_writers)


def write_jdbc_overwrite(
    df: DataFrame, url: str, table: str, props: dict[str, str] | None = None, max_writers: int = 8
) -> None:
    """Empties the table instead of dropping it, so its keys and grants stay."""
    _jdbc(df, url, table, {"truncate": "true", **(props or {})}, "overwrite", 1000, max_writers)


def write_jdbc_batched(
    df: DataFrame,
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    batch: int = 500,
    max_writers: int = 2,
) -> None:
    """Insert ``batch`` rows at a time; every task uses one connection and one transaction."""
    _jdbc(df, url, table, props, "append", batch, max_writers)
