import numpy as np
import pytest

from tallyloom.operators import best_products as bp
from tallyloom.operators import ml


def frame(spark, vectors, first=0):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id int, features array<float>")


def brute(left, right, n, first):
    products = left.astype(np.float32) @ right.astype(np.float32).T
    return {i: np.sort(row)[::-1][:n] for i, row in enumerate(products)}


@pytest.mark.parametrize("kind", ["plain", "one direction", "groups", "whole numbers", "opposite"])
def test_equals_all_pairs(spark, kind):
    rng = np.random.default_rng(5)
    left, right = rng.normal(size=(700, 6)), rng.normal(size=(3000, 6)) * rng.gamma(2, size=(3000, 1))
    if kind == "one direction":
        left, right = left + 5, right + 5
    elif kind == "groups":
        right = right / 10 + rng.normal(size=(7, 6))[rng.integers(7, size=3000)]
    elif kind == "whole numbers":  # many equal products, and vectors of length 0
        left, right = np.round(left), np.round(right / 2)
    elif kind == "opposite":  # all products are below 0
        left, right = np.abs(left), -np.abs(right)
    found = bp.best_products(frame(spark, left), frame(spark, right, 10), 10, "user_id", "item_id", group=200)
    assert found.dtypes == [("user_id", "int"), ("recommendations", "array<struct<item_id:int,rating:float>>")]
    lists = {r.user_id: r.recommendations for r in found.collect()}
    expected = brute(left, right, 10, 10)
    assert lists.keys() == expected.keys()
    for i, list_ in lists.items():
        assert np.allclose([r.rating for r in list_], expected[i], rtol=1e-5, atol=1e-5)
        assert len({r.item_id for r in list_}) == 10
        assert np.allclose([left[i] @ right[r.item_id - 10] for r in list_], expected[i], rtol=1e-4, atol=1e-4)


def test_cells_in_many_batches(spark):
    rng = np.random.default_rng(6)
    left, right = rng.normal(size=(50, 4)), rng.normal(size=(2500, 4))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 97)
    try:
        lists = {r.a: [x.rating for x in r.recommendations] for r in bp.best_products(frame(spark, left), frame(spark, right), 3, "a", "b").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(np.allclose(lists[i], want, rtol=1e-5, atol=1e-5) for i, want in brute(left, right, 3, 0).items())


def test_fewer_than_asked_for(spark):
    left, right = np.eye(3), np.array([[1.0, 2, 3], [3, 2, 1]])
    lists = {r.a: [(x.b, x.rating) for x in r.recommendations] for r in bp.best_products(frame(spark, left), frame(spark, right), 5, "a", "b").collect()}
    assert lists == {0: [(1, 3.0), (0, 1.0)], 1: [(1, 2.0), (0, 2.0)], 2: [(0, 3.0), (1, 1.0)]}
    assert bp.best_products(frame(spark, left), frame(spark, right).limit(0), 5, "a", "b").count() in (0, 3)


def test_recommendations_do_not_join_all_pairs(spark, plan):
    rows = [(u, i, float((u * 3 + i * 5) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 3]
    model = ml.als_train(spark.createDataFrame(rows, "user_id int, item_id int, rating double"), iters=2)
    for found, given in ((ml.recommend_for_all_users(model, 4), model.recommendForAllUsers(4)), (ml.recommend_for_all_items(model, 4), model.recommendForAllItems(4))):
        text = plan(found)
        assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
        ratings = lambda df: {r[0]: pytest.approx([x.rating for x in r[1]], rel=1e-4) for r in df.collect()}
        assert {k: v for k, v in ((r[0], [x.rating for x in r[1]]) for r in found.collect())} == ratings(given)
        assert dict(found.dtypes).keys() == dict(given.dtypes).keys() and found.schema[1].dataType.simpleString() == given.schema[1].dataType.simpleString()


def test_blocks_follow_the_rows(spark):
    rows = spark.createDataFrame([(u, i, float(u % 5)) for u in range(60) for i in range(40)], "user_id int, item_id int, rating double")
    assert ml.als_train(rows, iters=1, block_rows=100).userFactors.rdd.getNumPartitions() == 24
    assert ml.als_train(rows, iters=1, blocks=5, block_rows=100).userFactors.rdd.getNumPartitions() == 5


def test_a_task_reads_the_users_of_one_block(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ml.ALS, "fit", lambda self, df: seen.append((df, self.getNumUserBlocks())))
    ml.als_train(spark.createDataFrame([(u, i, 1.0) for u in range(-30, 30) for i in range(4)] + [(None, 1, 1.0)], "user_id int, item_id int, rating double"), blocks=7)
    df, blocks = seen[0]
    parts = df.rdd.mapPartitions(lambda rows: [{(r.user_id or 0) % 7 for r in rows}]).collect()
    assert blocks == 7 and sorted(map(sorted, parts)) == [[b] for b in range(7)] and df.count() == 241
