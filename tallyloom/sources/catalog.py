"""Catalog tables and tables of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_catalog_table(spark: SparkSession, name: str, where: Column | str | None = None) -> DataFrame:
    """A table by name; a condition on its partition column prunes whole folders."""
    table = spark.table(name)
    return table if where is None else table.where(where)


def create_catalog_table(
    spark: SparkSession, name: str, schema: str, sep: str = "\t", path: str | None = None
) -> DataFrame:
    """Declare a table over delimited text, with its folder when one is given."""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING csv OPTIONS (sep '{sep}'){where}")
    return spark.table(name)


def load_partitioned_table(
    df: DataFrame, name: str, by: str, path: str | None = None, files_per_value: int | None = None
) -> None:
    """Write ``df`` as a catalog table with one folder for each value of ``by``.

    ``files_per_value`` gathers the rows of a value into that many files; the
    split follows a hash of the whole row, so a value that holds most of the
    rows is still written by several tasks.
    """
    if files_per_value:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
        df = df.repartition(F.col(by), part)
    writer = df.write.mode("overwrite").partitionBy(by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_wide_column(spark: SparkSession, path: str, family: str, columns: list[str]) -> DataFrame:
    """Cells back to rows: one column for each qualifier that was asked for.

    The qualifiers are given, so no extra job looks for them, and cells of
    other qualifiers and families are left out by the scan.
    """
    cells = spark.read.parquet(path).filter(
        (F.col("family") == family) & F.col("qualifier").isin(columns)
    )
    return _pivoted(cells, columns)


def _pivoted(cells: DataFrame, columns: list[str]) -> DataFrame:
    picked = [F.max(F.when(F.col("qualifier") == c, F.col("value"))).alias(c) for c in columns]
    return cells.groupBy("rowkey").agg(*picked)


def read_clustered_cells(
    spark: SparkSession, name: str, family: str, columns: list[str], where: tuple[str, str] | None = None
) -> DataFrame:
    """The same from a table that ``clustered_cells`` wrote; ``where`` (qualifier, value) keeps rows with that cell.

    The rows that fit are found in the folder of one qualifier, and only their cells are put together.  The table is
    bucketed by row key, so neither step moves rows.
    """
    cells = spark.table(name).where(F.col("family") == family)
    wanted = cells.where(F.col("qualifier").isin(columns))
    if where:
        qualifier, value = where
        fitting = cells.where((F.col("qualifier") == qualifier) & (F.col("value") == value)).select("rowkey")
        wanted = wanted.join(fitting, "rowkey", "left_semi")
    return _pivoted(wanted, columns)
