"""Sources: write a given table in some format below the shared folder and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite.registry import query
from suite.tables import EMPLOYEES, PRODUCTS, employees, products, table, visits
from tallyloom import schemas
from tallyloom.shared_folder import new_path
from tallyloom.sinks.cells import clustered_cells, to_cells, wide_column_sink
from tallyloom.sinks.files import document_sink, write_csv, write_text
from tallyloom.sources import catalog, files, jdbc


@query(
    "read_text_pairs",
    """SELECT l_returnflag || l_linestatus AS "key", CAST(l_quantity AS INTEGER) AS "value" FROM lineitem""",
)
def _read_text_pairs(spark, sf_dir):
    path = new_path(spark, "pairs")
    line = F.concat("l_returnflag", "l_linestatus", F.lit(" \t"), F.col("l_quantity").cast("int").cast("string"))
    write_text(table(spark, sf_dir, "lineitem").select(line), path)
    return files.read_text_pairs(spark, path)


@query(
    "read_delimited",
    "WITH" + EMPLOYEES + " SELECT CAST(empno AS INTEGER) AS empno, ename, job, sal, deptno FROM employees",
)
def _read_delimited(spark, sf_dir):
    path = new_path(spark, "tsv")
    write_csv(employees(spark, sf_dir), path, sep="\t")
    return files.read_delimited(spark, path)


@query("read_delimited_schema", "WITH" + PRODUCTS + " SELECT * FROM products")
def _read_delimited_schema(spark, sf_dir):
    path = new_path(spark, "products")
    line = F.concat_ws("^", "product_id", "product_name", "extend_info")
    write_text(products(spark, sf_dir).select(line), path)
    return files.read_delimited_schema(spark, path, schemas.PRODUCT_INFO, sep="^")


@query(
    "read_multichar_delimited",
    """SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
       l_quantity AS rating, epoch_ms(o_orderdate) // 1000 AS rated_at
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _read_multichar_delimited(spark, sf_dir):
    path = new_path(spark, "ratings")
    bought = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    joined = items.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    fields = [
        F.col("o_custkey").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_quantity").cast("string"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string"),
    ]
    write_text(joined.select(F.concat_ws("::", *fields)), path)
    return files.read_multichar_delimited(spark, path, schemas.RATING)


@query("read_json_lines", "SELECT p_partkey, p_name, p_type || ';' || CAST(p_size AS VARCHAR) AS size_info FROM part")
def _read_json_lines(spark, sf_dir):
    info = F.concat("p_type", F.lit(";"), F.col("p_size").cast("string")).alias("size_info")
    root = new_path(spark, "reviews")
    document_sink(table(spark, sf_dir, "part").select("p_partkey", "p_name", info), root, "reviews")
    return files.read_json_lines(spark, f"{root}/reviews")


@query("read_parquet", "SELECT * FROM orders")
def _read_parquet(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/orders.parquet")


@query(
    "read_document_store",
    "WITH" + EMPLOYEES + " SELECT CAST(empno AS INTEGER) AS empno, ename, sal FROM employees WHERE deptno > 10",
)
def _read_document_store(spark, sf_dir):
    root = new_path(spark, "documents")
    document_sink(employees(spark, sf_dir), root, "emp")
    docs = files.read_document_store(spark, root, "emp", schemas.EMPLOYEE)
    return docs.filter(F.col("deptno") > 10).select("empno", "ename", "sal")


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query("create_catalog_table", "WITH" + EMPLOYEES + " SELECT CAST(empno AS INTEGER) AS empno, ename, sal, deptno FROM employees")
def _create_catalog_table(spark, sf_dir):
    path = new_path(spark, "emp")
    rows = employees(spark, sf_dir).select("empno", "ename", "sal", "deptno")
    write_csv(rows, path, sep="\t", header=False)
    schema = "empno INT, ename STRING, sal DOUBLE, deptno INT"
    return catalog.create_catalog_table(spark, _table_name("emp"), schema, path=path)


_MONTHS = """SELECT l_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem"""


def _load_months(spark, sf_dir) -> str:
    name = _table_name("months")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.date_format("l_shipdate", "yyyy-MM").alias("month")
    )
    catalog.load_partitioned_table(rows, name, "month", path=new_path(spark, "months"), files_per_value=4)
    return name


@query("load_partitioned_table", _MONTHS)
def _load_partitioned_table(spark, sf_dir):
    return catalog.read_catalog_table(spark, _load_months(spark, sf_dir))


@query("read_catalog_table", f"SELECT * FROM ({_MONTHS}) WHERE month = '1997-03'")
def _read_catalog_table(spark, sf_dir):
    return catalog.read_catalog_table(spark, _load_months(spark, sf_dir), F.col("month") == "1997-03")


@query(
    "read_wide_column",
    """SELECT CAST(o_orderkey AS VARCHAR) AS rowkey, o_orderstatus,
       CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""",
)
def _read_wide_column(spark, sf_dir):
    path = new_path(spark, "cells")
    wide_column_sink(table(spark, sf_dir, "orders"), "o_orderkey", "info", path)
    return catalog.read_wide_column(spark, path, "info", ["o_orderstatus", "o_custkey"])


@query(
    "read_clustered_cells",
    """SELECT CAST(o_orderkey AS VARCHAR) AS rowkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
)
def _read_clustered_cells(spark, sf_dir):
    """Two columns of the rows that have a certain cell in a third."""
    name = _table_name("cells")
    clustered_cells(to_cells(table(spark, sf_dir, "orders"), "o_orderkey"), name, new_path(spark, "cells"), buckets=8)
    return catalog.read_clustered_cells(spark, name, "info", ["o_custkey", "o_totalprice"], ("o_orderstatus", "F"))


@query("scan_columns_filter", "SELECT event_id, user_id FROM events WHERE event_type = 'signup'")
def _scan_columns_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return files.scan_columns_filter(events, ["event_id", "user_id"], "event_type", "signup")


_BOUNDS = [2000, 4000, 8000]


@query(
    "jdbc_range_predicates",
    """SELECT CASE WHEN o_custkey < 2000 THEN 0 WHEN o_custkey < 4000 THEN 1 WHEN o_custkey < 8000 THEN 2
       ELSE 3 END AS part, count(*) AS cnt FROM orders GROUP BY ALL""",
)
def _jdbc_range_predicates(spark, sf_dir):
    """Every order falls under exactly one of the predicates of a partitioned scan."""
    tests = jdbc.range_predicates("o_custkey", _BOUNDS)
    hits = F.array(*[F.when(F.expr(t), F.lit(i)) for i, t in enumerate(tests)])
    parts = table(spark, sf_dir, "orders").select(F.explode(F.array_compact(hits)).alias("part"))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "task_params",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_part, count(*) AS cnt FROM lineitem
       JOIN supplier ON l_suppkey = s_suppkey
       WHERE l_shipdate BETWEEN (SELECT min(o_orderdate) FROM orders WHERE o_orderstatus = 'F')
         AND (SELECT min(o_orderdate) + INTERVAL 30 DAY FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL""",
)
def _task_params(spark, sf_dir):
    """The dates of a task, found in a task table, limit the visits that are counted."""
    from tallyloom.operators.parsing import optional_date_range

    start = F.min("o_orderdate")
    dates = F.struct(
        F.date_format(start, "yyyy-MM-dd").alias("startDate"),
        F.date_format(start + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd").alias("endDate"),
    )
    done = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    tasks = done.agg(F.to_json(dates).alias("task_param")).withColumn("task_id", F.lit(7))
    params = jdbc.task_params(tasks, 7)
    kept = optional_date_range(visits(spark, sf_dir), "date_part", params.get("startDate"), params.get("endDate"))
    return kept.groupBy("date_part").agg(F.count(F.lit(1)).alias("cnt"))
