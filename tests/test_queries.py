"""Every registered query against its SQL on the small tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else round(float(value), 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = got.collect()
    assert rows
    if name in ORACLES:
        expected = duck.execute(ORACLES[name])
        names = [c[0] for c in expected.description]
        assert sorted(names) == sorted(got.columns)
        assert sorted_rows(rows, got.columns) == sorted_rows(expected.fetchall(), names)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() == 50


@pytest.mark.parametrize(
    "name",
    ["area_top10_products", "area_top10_visits", "enrich_region", "dynamic_blacklist", "filter_blacklisted_stream", "event_log_etl"],
)
def test_plans_have_no_cross_join_and_no_python(spark, plan, name):
    text = plan(QUERIES[name](spark, SF))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "SinglePartition"):
        assert step not in text
