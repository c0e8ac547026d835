"""Held-out accuracy, features, and the same model from the same rows."""

import numpy as np
import pytest

from tallyloom.llm import quality, subwords


def corpus():
    """Labels 1: running words; 0: words with bars between them, or each word over and over."""
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghé"), rng.integers(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        picked = list(rng.choice(words, rng.integers(5, 60)))
        bad = i % 4 == 0
        text = " ".join(picked) if not bad else " | ".join(picked) if i % 8 else " ".join(w for w in picked[:8] for _ in range(6))
        docs.append((i, text, "x"))
        labels.append((i, int(not bad)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Ab ab", "", "  x\n\ty ", "über 日本", "a" * 3000]
    numbers, owners = subwords.features(texts)
    for i, text in enumerate(texts):
        alone, zeros = subwords.features([text])
        assert not zeros.any()
        assert sorted(numbers[owners == i]) == sorted(alone)
    # " ab ": two words of 2 + 1 + 0 n-grams of lengths 3, 4, 5, a pair of equal words.
    assert len(subwords.features(["Ab ab"])[0]) == 2 * (2 + 1) + 2 + 1
    same = [set(subwords.features([t])[0]) for t in ("no no", "go go", "no go")]
    assert len(same[0] & same[1]) > len(same[0] & same[2] & same[1])
    assert [len(x) for x in subwords.features([])] == [0, 0]


def test_held_out_accuracy(spark):
    docs, labels = frames(spark, *corpus())
    model = quality.train(quality.labelled_texts(docs, labels.where(~quality.held_out()), "quality"))
    scored = quality.score_documents(docs, model).join(labels, "doc_id").where(quality.held_out()).collect()
    assert len(scored) > 100 and all(0 <= r.score <= 1 for r in scored)
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.95
    assert {r.predicted == int(r.score >= 0.7) for r in scored} == {True}


def test_the_same_rows_give_the_same_model_however_they_are_dealt(spark):
    docs, labels = frames(spark, *corpus())
    models = []
    for parts, shuffled in ((1, "4"), (7, "11")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        rows = quality.labelled_texts(docs.repartition(parts), labels, "quality")
        models.append(quality.train(rows.repartition(parts), rounds=1).pack())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert models[0] == models[1]


def test_odd_rows(spark):
    docs, labels = corpus()
    odd = [(None, None, "x"), (None, "text", "x"), (9001, None, "x"), (9002, "", "x"), (9003, "word " * 200_000, "x"), (3, docs[3][1], "x"), (3, "other", "y")]
    marks = labels + [(None, 0), (5, None), (5, 1), (9001, 0), (7777, 1)] + [(3, 0)] * 50
    given, known = frames(spark, docs + odd, marks)
    rows = quality.labelled_texts(given, known, "quality", max_labelled=10_000)
    assert rows.count() == len(docs), "one row for each labelled doc_id that has a text"
    found = quality.score_documents(given, quality.train(rows, rounds=1))
    assert found.columns == ["doc_id", "score", "predicted"] and found.count() == len(docs + odd)
    empty = {r.score for r in found.where("doc_id is null or doc_id in (9001, 9002)").collect()}
    assert len(empty) == 2, "null and empty texts score alike"
    few = quality.labelled_texts(given, known, "quality", max_labelled=100).count()
    assert 50 < few < 200


@pytest.mark.parametrize("labels", [[], [(1, None)]])
def test_without_labels(spark, labels):
    docs, known = frames(spark, [(1, "a", "x"), (2, None, "x")], labels)
    model = quality.train(quality.labelled_texts(docs, known, "quality"))
    assert model is None
    assert {(r.score, r.predicted) for r in quality.score_documents(docs, model).collect()} == {(0.5, 0)}
    assert quality.score_documents(docs.where("false"), model).count() == 0
