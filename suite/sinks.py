"""Sinks: write a given table, in one or more batches, and read back what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.tables import AD_CLICKS, EMPLOYEES, ad_clicks, employees, stream, table, with_ctes
from tallyloom.shared_folder import new_path
from tallyloom.sinks import cells, files, stores
from tallyloom.sources.files import read_document_store


@query("write_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _write_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return spark.read.schema("o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE").csv(path, header=True)


@query("write_text", """SELECT c_name || ' ' || c_mktsegment AS "value" FROM customer""")
def _write_text(spark, sf_dir):
    path = new_path(spark, "text")
    files.write_text(table(spark, sf_dir, "customer").select(F.concat_ws(" ", "c_name", "c_mktsegment")), path)
    return spark.read.text(path)


@query("document_sink", with_ctes(EMPLOYEES) + "SELECT empno, ename, job, sal, deptno FROM employees")
def _document_sink(spark, sf_dir):
    rows, root = employees(spark, sf_dir), new_path(spark, "documents")
    files.document_sink(rows, root, "emp")
    schema = "empno BIGINT, ename STRING, job STRING, sal DOUBLE, deptno INT"
    return read_document_store(spark, root, "emp", schema)


# The orders of each status come as one batch; their customers are the keys.
_STATUSES = ("F", "O", "P")
_BY_CUSTOMER = """
batches AS (
  SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS b,
         count(*) AS orders, max(o_orderkey) AS newest FROM orders GROUP BY ALL)"""


def _customer_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    for n, status in enumerate(_STATUSES):
        of_status = rows.filter(F.col("o_orderstatus") == status)
        yield n, of_status.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("newest")
        )


_LATEST = (
    with_ctes(_BY_CUSTOMER)
    + """SELECT o_custkey, orders, newest FROM batches
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY b DESC) = 1"""
)


@query("upsert_sink", _LATEST)
def _upsert_sink(spark, sf_dir):
    """Three batches, the last one twice: a batch that is run again changes nothing."""
    path = new_path(spark, "upserts")
    write = stores.upsert_sink(path, ["o_custkey"])
    for n, batch in _customer_batches(spark, sf_dir):
        write(batch, n)
    write(batch, n)
    folded = new_path(spark, "folded")
    stores.fold_upserts(spark, path, ["o_custkey"], folded)
    return stores.read_upserted(spark, folded, ["o_custkey"])


@query("hash_sink", _LATEST)
def _hash_sink(spark, sf_dir):
    path = new_path(spark, "hash")
    write = stores.hash_sink(path, "o_custkey")
    for n, batch in _customer_batches(spark, sf_dir):
        write(batch, n)
    return stores.read_upserted(spark, path, ["o_custkey"])


@query("set_sink", "SELECT DISTINCT o_custkey FROM orders")
def _set_sink(spark, sf_dir):
    path = new_path(spark, "set")
    write = stores.set_sink(path, "o_custkey")
    for n, batch in _customer_batches(spark, sf_dir):
        write(batch, n)
    return stores.read_set(spark, path, "o_custkey")


@query("replace_sink", with_ctes(_BY_CUSTOMER) + "SELECT o_custkey, orders, newest FROM batches WHERE b = 2")
def _replace_sink(spark, sf_dir):
    path = new_path(spark, "replaced")
    write = stores.replace_sink(path)
    for n, batch in _customer_batches(spark, sf_dir):
        write(batch, n)
    return stores.read_replaced(spark, path)


@query(
    "replace_partition_sink",
    with_ctes(AD_CLICKS)
    + """SELECT strftime(ts, '%Y%m%d') AS date, ad_id,
         CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'first' ELSE 'second' END AS run FROM ad_clicks""",
)
def _replace_partition_sink(spark, sf_dir):
    """All dates, then the later ones again: only their folders are replaced."""
    path = new_path(spark, "dates")
    write = stores.replace_partition_sink(path, "date")
    clicks = ad_clicks(spark, sf_dir)
    rows = clicks.select(F.date_format("ts", "yyyyMMdd").alias("date"), "ad_id")
    write(rows.withColumn("run", F.lit("first")), 0)
    later = rows.filter(F.col("date") >= "20240115")
    write(later.withColumn("run", F.lit("second")), 1)
    return spark.read.schema("ad_id BIGINT, run STRING, date STRING").parquet(path)


@query(
    "topic_sink",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "key",
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',' || o_custkey AS "value" FROM orders""",
)
def _topic_sink(spark, sf_dir):
    path = new_path(spark, "topic")
    rows = table(spark, sf_dir, "orders").withColumn("at", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    stores.topic_sink(rows, "o_orderkey", ["at", "o_custkey"], "parquet", {"path": path})
    return spark.read.parquet(path)


_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_CELLS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS rowkey, 'info' AS family, unnest({_COLUMNS}) AS qualifier,
 unnest([{", ".join(f"CAST({c} AS VARCHAR)" for c in _COLUMNS)}]) AS "value" FROM orders"""


@query("wide_column_sink", _CELLS)
def _wide_column_sink(spark, sf_dir):
    """Every column of every order."""
    path = f"{new_path(spark, 'cells')}/{cells.daily_table('orders', '2015-12-20')}"
    cells.wide_column_sink(table(spark, sf_dir, "orders"), "o_orderkey", "info", path)
    return spark.read.parquet(path)


@query("sorted_bulk_load", _CELLS)
def _sorted_bulk_load(spark, sf_dir):
    path = new_path(spark, "bulk")
    cells.sorted_bulk_load(table(spark, sf_dir, "orders"), "o_orderkey", path)
    return spark.read.parquet(path)


@query("memory_console_sink", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def _memory_console_sink(spark, sf_dir):
    """A handful of counts kept in memory under a name."""
    import uuid

    name = f"counts_{uuid.uuid4().hex}"
    counts = stream(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    running = stores.memory_console_sink(counts, name, mode="complete")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.table(name)
