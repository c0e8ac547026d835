import pytest
from pyspark.sql import functions as F

from tallyloom.shared_folder import new_path, shared_folder, staged
from tallyloom.sinks import cells, files, stores
from tallyloom.sources import catalog, jdbc


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def test_upserts_can_be_run_again(spark, tmp_path, rows):
    write = stores.upsert_sink(str(tmp_path), ["k"])
    write(frame(spark, [("a", 1), ("b", 1)]), 0)
    write(frame(spark, [("b", 2), ("c", 2)]), 1)
    expected = [("a", 1), ("b", 2), ("c", 2)]
    assert rows(stores.read_upserted(spark, str(tmp_path), ["k"])) == expected
    write(frame(spark, [("b", 2), ("c", 2)]), 1)
    assert rows(stores.read_upserted(spark, str(tmp_path), ["k"])) == expected
    stores.fold_upserts(spark, str(tmp_path), ["k"], str(tmp_path / "folded"))
    assert rows(stores.read_upserted(spark, str(tmp_path / "folded"), ["k"])) == expected


def test_upsert_needs_its_keys(spark, tmp_path):
    with pytest.raises(ValueError):
        stores.upsert_sink(str(tmp_path), ["x"])(frame(spark, [("a", 1)]), 0)


def test_sets_only_grow(spark, tmp_path, rows):
    path = str(tmp_path / "set")
    assert rows(stores.read_set(spark, path, "v")) == []
    write = stores.set_sink(path, "v")
    for n, members in enumerate([[1, 2, 2], [2, 3], []]):
        write(frame(spark, [("x", m) for m in members], "k string, v long"), n)
    assert rows(stores.read_set(spark, path, "v")) == [(1,), (2,), (3,)]


def test_replacing(spark, tmp_path, rows):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    for n, batch in enumerate([[("a", 1), ("b", 1)], [("b", 2)]]):
        stores.replace_sink(whole)(frame(spark, batch), n)
        stores.replace_partition_sink(parts, "k")(frame(spark, batch), n)
    assert rows(stores.read_replaced(spark, whole)) == [("b", 2)]
    assert rows(spark.read.parquet(parts).select("k", "v")) == [("a", 1), ("b", 2)]


def test_cells_and_back(spark, tmp_path, rows):
    df = frame(spark, [("r1", 1, "x"), ("r2", None, "y")], "id string, a int, b string")
    for _ in range(2):
        cells.wide_column_sink(df, "id", "info", str(tmp_path))
    back = catalog.read_wide_column(spark, str(tmp_path), "info", ["a", "b"])
    assert rows(back) == [("r1", "1", "x"), ("r2", None, "y")]
    assert rows(catalog.read_wide_column(spark, str(tmp_path), "other", ["a"])) == []


def test_bulk_files_are_sorted_and_do_not_overlap(spark, tmp_path):
    # One row key has most of the cells.
    wide = [("hot", f"q{i:05d}", "v") for i in range(3000)] + [(f"r{i:04d}", "q", "v") for i in range(1000)]
    given = frame(spark, wide, "rowkey string, qualifier string, value string").withColumn("family", F.lit("info"))
    cells.sorted_cells(given, 4).write.parquet(str(tmp_path / "bulk"))
    stored = spark.read.parquet(str(tmp_path / "bulk")).withColumn("file", F.input_file_name())
    by_file = {}
    for r in stored.withColumn("n", F.monotonically_increasing_id()).orderBy("n").collect():
        by_file.setdefault(r["file"], []).append((r["rowkey"], r["family"], r["qualifier"]))
    assert len(by_file) > 1 and all(keys == sorted(keys) for keys in by_file.values())
    spans = sorted((keys[0], keys[-1]) for keys in by_file.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sum(len(k) for k in by_file.values()) == 4000
    assert sum(any(k[0] == "hot" for k in keys) for keys in by_file.values()) > 1


def test_catalog_tables(spark, tmp_path, rows):
    df = frame(spark, [("2017-03-01", 1), ("2017-03-02", 2), ("2017-03-02", 3)], "date_part string, v int")
    catalog.load_partitioned_table(df, "visits_t", "date_part", path=str(tmp_path / "t"), files_per_value=2)
    try:
        got = catalog.read_catalog_table(spark, "visits_t", "date_part = '2017-03-02'")
        assert rows(got.select("v")) == [(2,), (3,)]
    finally:
        spark.sql("DROP TABLE visits_t")


class RecordingWriter:
    def __init__(self):
        self.calls = {}

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def jdbc(self, url, table, properties):
        self.calls |= {"url": url, "table": table, "properties": properties}


class Recording:
    """Stands for a DataFrame: no database may be started here."""

    def __init__(self):
        self.write = RecordingWriter()
        self.writers = None

    def repartition(self, n):
        self.writers = n
        return self


def test_jdbc_writers_pass_their_options():
    df = Recording()
    files.write_jdbc_batched(df, "jdbc:x", "t", {"user": "u"})
    assert df.write.calls == {
        "mode": "append",
        "url": "jdbc:x",
        "table": "t",
        "properties": {"batchsize": "500", "numPartitions": "2", "user": "u"},
    }
    assert df.writers == 2  # dealt by a shuffle, so the work before it stays parallel
    files.write_jdbc_overwrite(df, "jdbc:x", "t")
    assert df.write.calls["mode"] == "overwrite" and df.write.calls["properties"]["truncate"] == "true"
    files.write_jdbc_append(df, "jdbc:x", "t")
    assert df.write.calls["mode"] == "append"


def test_jdbc_predicates_cover_and_do_not_overlap(spark):
    df = spark.createDataFrame([(v,) for v in [*range(20), None]], "v int")
    for bounds in ([], [5], [5, 10, 15]):
        tests = jdbc.range_predicates("v", bounds)
        assert len(tests) == len(bounds) + 1
        assert sum(df.filter(t).count() for t in tests) == 21


def test_task_params(spark):
    tasks = frame(spark, [(1, '{"startDate":"2017-03-01"}'), (2, " "), (3, "[1]")], "task_id int, task_param string")
    assert jdbc.task_params(tasks, 1) == {"startDate": "2017-03-01"}
    for bad in (2, 3, 4):
        with pytest.raises(ValueError):
            jdbc.task_params(tasks, bad)


def test_staging_goes_to_the_shared_folder(spark):
    assert new_path(spark, "x").startswith(shared_folder(spark).rstrip("/"))
    assert staged(spark.range(3), "x").count() == 3


def test_clustered_cells(spark, tmp_path, rows, plan):
    given = [("r1", "info", "en", "e_l"), ("r1", "info", "pl", "web"), ("r2", "info", "en", "e_pv"), ("r2", "info", "pl", "app"),
             ("r1", "info", "pl", "abc"), ("r3", "info", "en", "e_l"), ("r3", "other", "pl", "x"), (None, "info", "en", "e_l")]
    given += [("hot", "info", f"q{i}", "v") for i in range(50)] + [("r1", "info", "en", "e_l")] * 200
    name = "clustered_for_test"
    df = spark.createDataFrame(given, "rowkey string, family string, qualifier string, value string")
    cells.clustered_cells(df, name, str(tmp_path / "t"), buckets=4)
    assert spark.table(name).count() == len(set(given)) - 1, "of a repeated cell the largest value stays"
    found = catalog.read_clustered_cells(spark, name, "info", ["en", "pl"], ("en", "e_l"))
    assert rows(found) == [("r1", "e_l", "web"), ("r3", "e_l", None)]
    assert rows(catalog.read_clustered_cells(spark, name, "info", ["pl"])) == [("r1", "web"), ("r2", "app")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(catalog.read_clustered_cells(spark, name, "info", ["en", "pl"], ("en", "e_l")))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text and text.count("Bucketed: true") == 2
    assert text.index("LeftSemi") > text.index("Aggregate"), "the condition lies below the pivot"
    assert "InMemoryFileIndex(2 paths)" in text and "InMemoryFileIndex(1 paths)" in text
    spark.sql(f"DROP TABLE {name}")
