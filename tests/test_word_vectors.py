import random

import numpy as np
import pytest

from tallyloom.operators import ml
from tallyloom.operators import word_vectors as wv


@pytest.fixture(scope="module")
def texts(spark):
    """Two worlds of words that never meet; ``a0`` and ``a1`` stand in the same places."""
    rng, rows = random.Random(1), []
    for i in range(3000):
        world = "ab"[i % 2]
        rows.append(([f"{world}{rng.randrange(40)}" for _ in range(20)] + ["once" + str(i)],))
    return spark.createDataFrame([*rows, (None,), ([],)], "words array<string>")


def test_a_large_vocabulary_stays_off_the_driver(texts, monkeypatch):
    monkeypatch.setattr(ml, "Word2Vec", None)  # Spark's trainer has all vectors on the driver
    found = ml.word2vec_synonyms(texts, "words", "a0", 39, partitions=3, driver_words=50)
    assert found.dtypes == [("word", "string"), ("similarity", "double")]
    rows = found.collect()
    assert {r.word for r in rows} == {f"a{i}" for i in range(1, 40)}, "words of the same texts are nearer than all others"
    assert all(-1.0001 <= r.similarity <= 1.0001 for r in rows) and rows[0].similarity > 0.5
    assert [r.similarity for r in rows] == sorted((r.similarity for r in rows), reverse=True)


def test_each_word_has_one_vector(spark, texts):
    vocabulary = spark.createDataFrame([(f"{w}{i}", 700) for w in "ab" for i in range(40)], "word string, cnt bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 13)
    try:
        rows = wv.word_vectors(texts, "words", vocabulary, 42, 5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.word for r in rows) == sorted(f"{w}{i}" for w in "ab" for i in range(40))
    vectors = np.array([np.frombuffer(r.vector, np.float32) for r in rows])
    assert vectors.shape == (80, 100) and np.isfinite(vectors).all()


def test_an_unknown_word(texts):
    with pytest.raises(ValueError):
        ml.word2vec_synonyms(texts, "words", "once1", driver_words=50)


def test_averages_go_across_batches():
    rows = [("a", 1.0), ("b", 2.0), ("b", 4.0), ("b", 6.0), ("c", 1.0)]
    for cut in range(1, 5):
        batches = [wv._named(wv.pa.array([w for w, _ in part]), np.array([[v] * 100 for _, v in part], np.float32)) for part in (rows[:cut], rows[cut:])]
        got = [(w, wv._numbers(out.column("vector"))[i][0]) for out in wv._average(batches) for i, w in enumerate(out.column("word").to_pylist())]
        assert got == [("a", 1.0), ("b", 4.0), ("c", 1.0)]


def test_repeated_words_do_not_run_away():
    words = wv.pa.array([f"w{i}" for i in range(1000)])
    part = wv._Part([(words, np.full(1000, 10), np.arange(1000) * 7919)], 1e5, [1, 2])
    part.train(wv.pa.array([["w1"] * 5000, ["w1", "w2"] * 5000, None, []] * 5))
    assert np.isfinite(part.given).all() and np.linalg.norm(part.given, axis=1).max() < 100
