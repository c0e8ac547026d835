import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tallyloom.operators import ml
from tallyloom.plans.news import classify_news, classify_titles, fit_news, load_news
from tallyloom.plans.recommend import train_and_score


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(u, i, float((u * 3 + i * 5) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 3]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double")


def test_recommendation(spark, tmp_path, ratings):
    model, metrics = train_and_score(ratings, iters=5, blocks=4)
    rmse, mse = metrics.first()
    assert rmse < 1.0 and mse == pytest.approx(rmse**2)
    scored = ml.als_predict(model, ratings)
    assert rmse == pytest.approx(
        RegressionEvaluator(labelCol="rating", predictionCol="prediction", metricName="rmse").evaluate(scored)
    )
    one = ml.recommend_for_one(model, 3, 5).first()["recommendations"]
    everyone = ml.recommend_for_all_users(model, 5).filter("user_id = 3").first()["recommendations"]
    assert [r["item_id"] for r in one] == [r["item_id"] for r in everyone]
    assert len(ml.recommend_for_one(model, 3, 5, kind="item").first()["recommendations"]) == 5
    again = ml.save_load_model(model, str(tmp_path / "als"))
    assert ml.als_factors(again).count() == 50
    assert ml.als_predict(again, ratings).agg(F.sum("prediction")).first() == scored.agg(F.sum("prediction")).first()


def test_unknown_pairs_are_nan_unless_dropped(spark, ratings):
    pairs = spark.createDataFrame([(0, 1), (999, 1)], "user_id int, item_id int")
    kept = ml.als_predict(ml.als_train(ratings, iters=1), pairs)
    assert kept.filter(F.isnan("prediction")).count() == 1
    assert ml.als_predict(ml.als_train(ratings, iters=1, cold_start="drop"), pairs).count() == 1


def test_news(spark):
    topics = {"b": "stock market bank", "t": "phone chip software", "e": "film music star", "m": "health doctor study", "x": "no such"}
    rows = [(f"{words} item{i % 7}", c) for c, words in topics.items() for i in range(40)]
    scored = classify_news(spark.createDataFrame(rows, "title string, category string"))
    metrics = ml.multiclass_metrics(scored).first()
    assert metrics["accuracy"] > 0.9
    judge = MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label", predictionCol="prediction")
    assert metrics["accuracy"] == pytest.approx(judge.evaluate(scored))
    counts = ml.confusion_counts(scored).collect()
    assert sum(r["cnt"] for r in counts) == metrics["cnt"]
    assert {r["label"] for r in counts} <= {0.0, 1.0, 2.0, 3.0}


def test_synonyms_and_features(spark):
    texts = spark.createDataFrame([("the stock rose, the bank fell",), ("the stock fell, the bank rose",)] * 20, "t string")
    words = ml.news_words(texts, "t")
    near = ml.word2vec_synonyms(words, "words", "stock", 3)
    assert near.count() == 3
    features = ml.tfidf_features(words, dims=1000).select("features").first()[0]
    assert features.size == 1000


def test_a_news_model_is_kept_for_titles_to_come(spark, tmp_path):
    topics = {"b": "Stock market, bank.", "t": "phone chip software", "e": "film music star", "m": "health doctor study", "x": "no such"}
    rows = [(f"{words} item{i % 7}", c) for c, words in topics.items() for i in range(40)] + [(None, "b")]
    model = fit_news(spark.createDataFrame(rows, "title string, category string"), dims=1000)
    model.write().save(str(tmp_path / "news"))
    titles = spark.createDataFrame([(1, "The BANK, the market", 7.0), (2, "a new chip", None), (3, None, 1.0), (4, "", 2.0)], "n int, title string, prediction_note double")
    for given in (model, load_news(str(tmp_path / "news"))):
        found = classify_titles(given, titles)
        assert found.columns == [*titles.columns, "predicted_category"]
        got = {r.n: (r.title, r.predicted_category) for r in found.collect()}
        assert got[1] == ("The BANK, the market", "b") and got[2] == ("a new chip", "t")
        assert got[3][0] is None and got[4][0] == "" and got[3][1] == got[4][1], "without words, by frequency of the classes"
    with pytest.raises(ValueError):
        fit_news(titles, labels={"a": 1.0, "b": 3.0})
