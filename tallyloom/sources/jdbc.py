"""Relational sources over JDBC."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict[str, str] | None = None) -> DataFrame:
    """A whole table over one connection; for tables of the size of a dimension."""
    return spark.read.jdbc(url, table, properties=props or {})


def read_jdbc_predicates(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str],
    props: dict[str, str] | None = None,
) -> DataFrame:
    """One partition for each predicate; they must cover the table and not overlap."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=props or {})


def range_predicates(column: str, bounds: list) -> list[str]:
    """Predicates that put every row in exactly one partition, nulls included.

    ``bounds`` are the inner borders: n borders make n + 1 predicates.
    """

    def literal(value):
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

    borders = [literal(b) for b in sorted(bounds)]
    if not borders:
        return ["1 = 1"]
    first = f"{column} < {borders[0]} OR {column} IS NULL"
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(borders, borders[1:])]
    return [first, *inner, f"{column} >= {borders[-1]}"]


def task_params(tasks: DataFrame, task_id: int) -> dict:
    """The parameters of one job: the JSON object in ``task_param`` of its row.

    ``tasks`` is the task table from any source, with ``task_id`` and ``task_param``.
    """
    rows = tasks.filter(F.col("task_id") == task_id).select("task_param").limit(1).collect()
    if not rows or not (rows[0][0] or "").strip():
        raise ValueError(f"no parameters for task {task_id}")
    params = json.loads(rows[0][0])
    if not isinstance(params, dict):
        raise ValueError(f"the parameters of task {task_id} are not a JSON object")
    return params
