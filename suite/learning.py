"""Recommendation and classification.

Trained numbers have no SQL twin, so the queries compare what must hold for them: factors solve their equations,
predictions are products of factors, recommendations are the best of all, weights follow from counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.tables import RATINGS, ratings, table, with_ctes
from tallyloom.operators import ml
from tallyloom.operators.parsing import tokenize_lowercase
from tallyloom.plans.news import classify_news, classify_titles, fit_news, load_news
from tallyloom.plans.recommend import train_and_score
from tallyloom.shared_folder import new_path, staged

_LANGUAGES = {"de": 0.0, "en": 1.0, "es": 2.0, "fr": 3.0}
_ROUNDS = 10
_RANK = 10
#: The regularisation that training uses if none is given.
_PENALTY = 0.1
_TOKENS = r"""
tokens AS (
  SELECT doc_id, list_transform(regexp_split_to_array(regexp_replace(text, '\s+$', ''), '\s+'),
                                lambda x: regexp_replace(lower(x), '[,.]', '', 'g')) AS w FROM documents)"""


def _rated(spark, sf_dir):
    """The ratings, joined once and written: training and what is compared read them several times."""
    return staged(ratings(spark, sf_dir), "ratings")


def _train(rows):
    return ml.als_train(rows, iters=_ROUNDS)


def _product(left: str, right: str) -> F.Column:
    """The inner product of two factors."""
    pairs = F.zip_with(left, right, lambda x, y: x.cast("double") * y)
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def _factors(model, kind: str, name: str):
    return ml.als_factors(model).where(F.col("kind") == kind).select(F.col("id").alias(f"{kind}_id"), F.col("features").alias(name))


def _solved(model, rows):
    """user_id, solved: the last step of training solves the normal equations of a user for the factors of the items."""
    joined = rows.join(_factors(model, "item", "q"), "item_id").join(_factors(model, "user", "p"), "user_id")
    error = _product("p", "q") - F.col("rating")
    slope = [F.sum(error * F.col("q")[k]) + _PENALTY * F.count("*") * F.first("p")[k] for k in range(_RANK)]
    size = F.sum(F.abs("rating") * F.sqrt(_product("q", "q"))) + F.count("*")
    return joined.groupBy("user_id").agg((F.greatest(*[F.abs(s) for s in slope]) <= 1e-4 * size).alias("solved"))


@query("als_train", with_ctes(RATINGS) + "SELECT DISTINCT user_id, true AS solved, true AS scored FROM ratings")
def _als_train(spark, sf_dir):
    """Every user's factors solve their equations, and the model's error is that of the products of its factors."""
    rows = _rated(spark, sf_dir)
    model, metrics = train_and_score(rows, iters=_ROUNDS)
    joined = rows.join(_factors(model, "item", "q"), "item_id").join(_factors(model, "user", "p"), "user_id")
    error = _product("p", "q") - F.col("rating")
    true_mse = joined.agg(F.avg(error * error)).first()[0]
    scored = abs(metrics.first()["mse"] - true_mse) <= 1e-4 * true_mse
    return _solved(model, rows).withColumn("scored", F.lit(scored))


@query(
    "als_factors",
    with_ctes(RATINGS)
    + """SELECT 'user' AS kind, user_id AS id, 10 AS size, true AS solved FROM (SELECT DISTINCT user_id FROM ratings)
         UNION ALL SELECT 'item', item_id, 10, NULL FROM (SELECT DISTINCT item_id FROM ratings)""",
)
def _als_factors(spark, sf_dir):
    rows = _rated(spark, sf_dir)
    model = _train(rows)
    solved = _solved(model, rows).select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "solved")
    sized = ml.als_factors(model).select("kind", "id", F.size("features").alias("size"))
    return sized.join(solved, ["kind", "id"], "left")


def _lists(model, best, rows, kind, other):
    """Of each list: its length, whether its scores are products of factors that fall, and whether it has the best.

    No pair that was rated and is not on the list has a score above that of the last one on it.
    """
    mine, theirs = _factors(model, kind, "mine"), _factors(model, other, "theirs")
    entries = best.select(f"{kind}_id", F.posexplode("recommendations").alias("place", "r")).select(f"{kind}_id", "place", f"r.{other}_id", "r.rating")
    entries = staged(entries, "entries")
    scored = entries.join(mine, f"{kind}_id").join(theirs, f"{other}_id").withColumn("product", _product("mine", "theirs"))
    near = F.abs(F.col("rating") - F.col("product")) <= 1e-4 * (1 + F.abs("product"))
    order = F.array_sort(F.collect_list(F.struct("place", "rating")))["rating"]
    lists = scored.groupBy(f"{kind}_id").agg(
        F.count_distinct(f"{other}_id").cast("int").alias("n"), F.every(near).alias("is_product"), order.alias("ratings"), F.min("rating").alias("last")
    )
    falls = F.col("ratings") == F.sort_array("ratings", asc=False)
    pairs = rows.select(f"{kind}_id", f"{other}_id").distinct().join(entries.select(f"{kind}_id", f"{other}_id"), [f"{kind}_id", f"{other}_id"], "left_anti")
    rest = pairs.join(mine, f"{kind}_id").join(theirs, f"{other}_id").groupBy(f"{kind}_id").agg(F.max(_product("mine", "theirs")).alias("next"))
    nothing_better = F.coalesce(F.col("next") <= F.col("last") + 1e-4 * (1 + F.abs("last")), F.lit(True))
    return lists.join(rest, f"{kind}_id", "left").select(f"{kind}_id", "n", "is_product", falls.alias("falls"), nothing_better.alias("has_best"))


@query(
    "recommend_for_all_users",
    with_ctes(RATINGS)
    + """SELECT user_id, CAST(least(10, (SELECT count(DISTINCT item_id) FROM ratings)) AS INTEGER) AS n,
         true AS is_product, true AS falls, true AS has_best FROM (SELECT DISTINCT user_id FROM ratings)""",
)
def _recommend_for_all_users(spark, sf_dir):
    rows = _rated(spark, sf_dir)
    model = _train(rows)
    return _lists(model, ml.recommend_for_all_users(model), rows, "user", "item")


@query(
    "recommend_for_all_items",
    with_ctes(RATINGS)
    + """SELECT item_id, CAST(least(10, (SELECT count(DISTINCT user_id) FROM ratings)) AS INTEGER) AS n,
         true AS is_product, true AS falls, true AS has_best FROM (SELECT DISTINCT item_id FROM ratings)""",
)
def _recommend_for_all_items(spark, sf_dir):
    rows = _rated(spark, sf_dir)
    model = _train(rows)
    return _lists(model, ml.recommend_for_all_items(model), rows, "item", "user")


@query(
    "recommend_for_one",
    with_ctes(RATINGS)
    + """, sides AS (
           SELECT 'user' AS kind, count(DISTINCT item_id) AS n FROM ratings HAVING bool_or(user_id = 1)
           UNION ALL SELECT 'item', count(DISTINCT user_id) FROM ratings HAVING bool_or(item_id = 1))
         SELECT kind, unnest(range(least(n, 10))) AS place, true AS is_product, true AS is_best FROM sides""",
)
def _recommend_for_one(spark, sf_dir):
    """For user 1 and for item 1: each score is a product of factors, and at each place none is better."""
    model = _train(_rated(spark, sf_dir))

    def side(kind, other):
        one = _factors(model, kind, "mine").where(F.col(f"{kind}_id") == 1).first()
        mine = F.lit(list(one.mine) if one else []).cast("array<float>")
        scores = _factors(model, other, "theirs").withColumn("mine", mine).select(f"{other}_id", _product("mine", "theirs").alias("score"))
        best = F.lit([r.score for r in scores.orderBy(F.desc("score")).limit(10).collect()]).cast("array<double>")
        given = ml.recommend_for_one(model, 1, 10, kind).select(F.posexplode("recommendations").alias("place", "r"))
        given = given.select(F.col("place").cast("long").alias("place"), f"r.{other}_id", "r.rating")
        near = lambda x: F.abs(F.col("rating") - x) <= 1e-4 * (1 + F.abs(x))
        return given.join(scores, f"{other}_id").select(
            F.lit(kind).alias("kind"), "place", near(F.col("score")).alias("is_product"), near(F.get(best, F.col("place").cast("int"))).alias("is_best")
        )

    return side("user", "item").unionByName(side("item", "user"))


@query(
    "als_predict",
    with_ctes(RATINGS) + "SELECT DISTINCT user_id, item_id, true AS is_product FROM ratings",
)
def _als_predict(spark, sf_dir):
    rows = _rated(spark, sf_dir)
    model = _train(rows)
    pairs = rows.select("user_id", "item_id").distinct()
    scored = ml.als_predict(model, pairs).join(_factors(model, "item", "q"), "item_id").join(_factors(model, "user", "p"), "user_id")
    product = _product("p", "q")
    near = F.abs(F.col("prediction") - product) <= 1e-4 * (1 + F.abs(product))
    return scored.select("user_id", "item_id", near.alias("is_product"))


@query(
    "regression_metrics",
    with_ctes(RATINGS)
    + """, scored AS (SELECT rating, avg_rating FROM ratings JOIN
           (SELECT item_id, avg(rating) AS avg_rating FROM ratings GROUP BY item_id) USING (item_id))
         SELECT round(sqrt(avg((rating - avg_rating) * (rating - avg_rating))), 6) AS rmse,
                round(avg((rating - avg_rating) * (rating - avg_rating)), 6) AS mse FROM scored""",
)
def _regression_metrics(spark, sf_dir):
    """The average rating of an item as its prediction."""
    rows = ratings(spark, sf_dir)
    mean = rows.groupBy("item_id").agg(F.avg("rating").alias("prediction"))
    metrics = ml.regression_metrics(rows.join(mean, "item_id"), "rating", "prediction")
    return metrics.select(F.round("rmse", 6).alias("rmse"), F.round("mse", 6).alias("mse"))


@query(
    "save_load_model",
    with_ctes(RATINGS)
    + """SELECT 'user' AS kind, user_id AS id, true AS same FROM (SELECT DISTINCT user_id FROM ratings)
         UNION ALL SELECT 'item', item_id, true FROM (SELECT DISTINCT item_id FROM ratings)""",
)
def _save_load_model(spark, sf_dir):
    """The factors before and after."""
    model = _train(_rated(spark, sf_dir))
    loaded = ml.als_factors(ml.save_load_model(model, new_path(spark, "model"))).withColumnRenamed("features", "loaded")
    both = ml.als_factors(model).join(loaded, ["kind", "id"], "full")
    return both.select("kind", "id", F.col("features").eqNullSafe(F.col("loaded")).alias("same"))


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


@query("tfidf_features", with_ctes(_TOKENS) + "SELECT doc_id, 100000 AS dims, len(w) AS n_words, true AS weighted FROM tokens")
def _tfidf_features(spark, sf_dir):
    """Term frequencies add up to the words of a text, and each weight is what its term's frequencies say."""
    docs = tokenize_lowercase(_texts(spark, sf_dir), "text").select("doc_id", "words")
    both = ml.term_frequencies(ml.tfidf_features(docs)).withColumns({"f": F.unwrap_udt("features"), "t": F.unwrap_udt("tf")})
    lists = both.select("doc_id", F.col("f.size").alias("dims"), F.col("f.indices").alias("term"), F.col("f.values").alias("weight"), F.col("t.values").alias("n"))
    terms = lists.select("doc_id", "dims", F.inline(F.arrays_zip("term", "weight", "n")))
    known = terms.groupBy("term").agg(F.count("*").alias("df"))
    expected = F.col("n") * F.log((F.lit(docs.count()) + 1) / (F.col("df") + 1))
    return terms.join(known, "term").groupBy("doc_id").agg(
        F.first("dims").alias("dims"), F.sum("n").cast("long").alias("n_words"), F.every(F.abs(F.col("weight") - expected) <= 1e-9 * (1 + expected)).alias("weighted")
    )


@query(
    "label_index",
    """SELECT doc_id, CASE lang WHEN 'de' THEN 0.0::DOUBLE WHEN 'en' THEN 1.0 WHEN 'fr' THEN 3.0 END AS label
       FROM documents WHERE lang IN ('de', 'en', 'fr')""",
)
def _label_index(spark, sf_dir):
    known = {k: v for k, v in _LANGUAGES.items() if k != "es"}
    return ml.label_index(_texts(spark, sf_dir), "lang", known).select("doc_id", "label")


# A test part that both engines can draw: texts whose digest begins with 0, 1 or 2.
_TEST_TEXTS = "substr(md5(text), 1, 1) < '3'"


@query(
    "naive_bayes_classify",
    f"SELECT lang, count(*) AS cnt, true AS weighed FROM documents WHERE {_TEST_TEXTS} GROUP BY lang",
)
def _naive_bayes_classify(spark, sf_dir):
    """Rows of the test part, each with the class that the counts of the training part make the likeliest."""
    docs = ml.label_index(tokenize_lowercase(_texts(spark, sf_dir), "text"), "lang", _LANGUAGES)
    features = staged(ml.tfidf_features(docs).select("doc_id", "lang", "label", "features", F.expr(_TEST_TEXTS).alias("is_test")), "features")
    train, test = features.where("NOT is_test"), features.where("is_test")
    found = ml.naive_bayes_classify(train, test)
    entries = lambda df: df.withColumn("f", F.unwrap_udt("features")).select(
        "doc_id", "lang", "label", F.inline(F.arrays_zip(F.col("f.indices").alias("term"), F.col("f.values").alias("weight")))
    )
    sums = entries(train).groupBy("label", "term").agg(F.sum("weight").alias("w"))
    totals = sums.groupBy("label").agg(F.sum("w").alias("total")).join(train.groupBy("label").agg(F.count("*").alias("n")), "label")
    totals = staged(totals, "totals")
    classes, rows = totals.count(), F.lit(train.count())
    # A class that has not seen a term gives it the same as any such term: what a text loses or gains by the terms it has seen.
    unseen = F.log(F.col("total") + 100_000)
    seen = sums.join(totals, "label").select(F.col("label").alias("class"), "term", F.log(F.col("w") + 1).alias("gain"))
    base = F.log((F.col("n") + 1) / (rows + classes))
    gains = entries(test).join(seen, "term").groupBy("doc_id", "class").agg(F.sum(F.col("weight") * F.col("gain")).alias("gain"))
    weights = entries(test).groupBy("doc_id").agg(F.sum("weight").alias("weight"))
    each = found.select("doc_id", "lang", "prediction").withColumn("class", F.explode(F.lit([float(x) for x in _LANGUAGES.values()])))
    scored = each.join(F.broadcast(totals.withColumnRenamed("label", "class")), "class").join(gains, ["doc_id", "class"], "left").join(weights, "doc_id", "left")
    score = base + F.coalesce("gain", F.lit(0.0)) - F.coalesce("weight", F.lit(0.0)) * unseen
    judged = scored.withColumn("score", score).groupBy("doc_id", "lang").agg(
        F.max("score").alias("best"), F.max(F.when(F.col("class") == F.col("prediction"), F.col("score"))).alias("given")
    )
    right = F.col("given") >= F.col("best") - 1e-6 * (1 + F.abs(F.col("best")))
    return judged.groupBy("lang").agg(F.count("*").alias("cnt"), F.every(right).alias("weighed"))


@query("classify_news", "SELECT lang, true AS most, true AS known FROM documents GROUP BY lang")
def _classify_news(spark, sf_dir):
    """The whole test of a model, by its own split: at least half of each language's test rows are told from the others."""
    scored = classify_news(_texts(spark, sf_dir), "text", "lang", _LANGUAGES)
    names = F.get(F.lit(sorted(_LANGUAGES, key=_LANGUAGES.get)), F.col("label").cast("int"))
    return scored.groupBy(names.alias("lang")).agg(
        (2 * F.count_if(F.col("label") == F.col("prediction")) >= F.count("*")).alias("most"), F.every(F.col("prediction").isin(*_LANGUAGES.values())).alias("known")
    )


@query("classify_new_titles", "SELECT doc_id, true AS same, true AS known FROM documents")
def _classify_new_titles(spark, sf_dir):
    """Texts without a label: the model that was loaded says of every one what the fitted one does."""
    texts, path = _texts(spark, sf_dir), new_path(spark, "news-model")
    model = fit_news(texts, "text", "lang", _LANGUAGES)
    model.write().save(path)
    new = texts.drop("lang")
    fitted = classify_titles(model, new, "text").select("doc_id", F.col("predicted_category").alias("fitted"))
    loaded = classify_titles(load_news(path), new, "text").select("doc_id", "predicted_category")
    return fitted.join(loaded, "doc_id", "full").select(
        "doc_id", F.col("fitted").eqNullSafe(F.col("predicted_category")).alias("same"), F.col("fitted").isin(*_LANGUAGES).alias("known")
    )


@query(
    "multiclass_metrics",
    """SELECT count(*) AS cnt, count(*) FILTER (quality = toxic) AS correct,
       count(*) FILTER (quality = toxic) / count(*) AS accuracy FROM labels""",
)
def _multiclass_metrics(spark, sf_dir):
    return ml.multiclass_metrics(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("confusion_counts", "SELECT quality, toxic, count(*) AS cnt FROM labels GROUP BY ALL")
def _confusion_counts(spark, sf_dir):
    return ml.confusion_counts(table(spark, sf_dir, "labels"), "quality", "toxic")


@query(
    "word2vec_synonyms",
    r"""WITH words AS (
          SELECT unnest(regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s+')) AS word FROM documents),
        vocabulary AS (SELECT replace(word, ',', '') AS word FROM words GROUP BY 1 HAVING count(*) >= 5)
        SELECT least(10, count(*) - 1) AS n, least(10, count(*) - 1) AS known, true AS others FROM vocabulary""",
)
def _word2vec_synonyms(spark, sf_dir):
    """As many different words as asked for, all of the vocabulary and none the word itself."""
    words = ml.news_words(_texts(spark, sf_dir), "text").select("words")
    vocabulary = words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("cnt")).where("cnt >= 5")
    found = ml.word2vec_synonyms(words, "words", "the")
    return found.join(vocabulary, "word", "left").agg(
        F.count_distinct("word").alias("n"), F.count("cnt").alias("known"), F.every(F.col("word") != "the").alias("others")
    )
