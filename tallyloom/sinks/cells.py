"""Rows as cells ``(rowkey, family, qualifier, value)`` and sorted files of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_cells(df: DataFrame, rowkey: str, family: str = "info", columns: list[str] | None = None) -> DataFrame:
    """One cell for each column that has a value; values become text."""
    names = columns or [c for c in df.columns if c != rowkey]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value")) for c in names]
    )
    return _exploded(df, rowkey, family, pairs)


def map_to_cells(df: DataFrame, rowkey: str, fields: str, family: str = "info") -> DataFrame:
    """One cell for each entry of a map column."""
    pairs = F.transform(
        F.map_entries(fields), lambda e: F.struct(e["key"].alias("qualifier"), e["value"].alias("value"))
    )
    return _exploded(df, rowkey, family, pairs)


def _exploded(df: DataFrame, rowkey: str, family: str, pairs) -> DataFrame:
    return (
        df.select(F.col(rowkey).cast("string").alias("rowkey"), F.explode(pairs).alias("cell"))
        .filter(F.col("cell.value").isNotNull())
        .select("rowkey", F.lit(family).alias("family"), "cell.qualifier", "cell.value")
    )


def daily_table(prefix: str, date: str) -> str:
    """``event_logs`` and ``2015-12-20`` give ``event_logs20151220``."""
    return prefix + date.replace("-", "")


def wide_column_sink(
    df: DataFrame, rowkey: str, family: str, path: str, columns: list[str] | None = None
) -> None:
    """Replace the cell table at ``path`` by the cells of ``df``; a re-run gives the same table."""
    to_cells(df, rowkey, family, columns).write.mode("overwrite").partitionBy("family").parquet(path)


def sorted_cells(cells: DataFrame, n: int | None = None) -> DataFrame:
    """Cells in ranges, sorted inside each range.

    The range takes in the qualifier too, so that a row key with very many
    cells can be spread over several files.
    """
    order = ["rowkey", "family", "qualifier"]
    ranged = cells.repartitionByRange(n, *order) if n else cells.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def sorted_bulk_load(
    df: DataFrame,
    rowkey: str,
    path: str,
    n: int | None = None,
    family: str = "info",
    columns: list[str] | None = None,
) -> None:
    """Files that follow each other in key order, each sorted, ready for a bulk load."""
    sorted_cells(to_cells(df, rowkey, family, columns), n).write.mode("overwrite").parquet(path)


def clustered_cells(cells: DataFrame, name: str, path: str | None = None, buckets: int = 64) -> None:
    """A catalog table with one folder for each family and qualifier, bucketed and sorted by row key within it.

    A read of some qualifiers opens their folders only, and what is grouped or joined by row key needs no shuffle.  Of a
    repeated cell the largest value stays.  Every file is written by one task, which has one bucket of one qualifier:
    a row of very many cells, or a cell that is there very often, is spread or folded before.
    """
    place = ["rowkey", "family", "qualifier"]
    single = cells.groupBy(*place).agg(F.max("value").alias("value"))
    bucket = F.pmod(F.hash("rowkey"), F.lit(buckets)).alias("bucket")
    writer = (
        single.repartition(bucket, "family", "qualifier")
        .select("rowkey", "value", "family", "qualifier")
        .write.mode("overwrite")
        .partitionBy("family", "qualifier")
        .bucketBy(buckets, "rowkey")
        .sortBy("rowkey")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
