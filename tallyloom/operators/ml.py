"""Recommendation and text classification with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, Word2Vec
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import split_words
from tallyloom.operators.best_products import best_products
from tallyloom.operators.word_vectors import nearest_words, word_vectors
from tallyloom.shared_folder import staged

# News categories and their numbers.
NEWS_LABELS = {"b": 0.0, "t": 1.0, "e": 2.0, "m": 3.0}

#: Ratings of a block of ``als_train``: about 50 bytes each while it is made, and a factor of the other side for each at most.
BLOCK_ROWS = 2_000_000
#: Words of a vocabulary, at most, that ``word2vec_synonyms`` leaves to Spark's trainer.
DRIVER_WORDS = 100_000


def als_train(
    df: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    rating: str = "rating",
    rank: int = 10,
    iters: int = 10,
    seed: int = 42,
    blocks: int | None = None,
    cold_start: str = "nan",
    block_rows: int = BLOCK_ROWS,
) -> ALSModel:
    """Explicit ratings.  Blocks follow the rows and the cluster's parallelism if not given.

    A task holds a block: its ratings, and the factors of the other side that they need, so a block has about
    ``block_rows`` ratings at most (those of one user or item stay together).  Between iterations blocks lie on disk.
    The factors of each iteration are checkpointed to the shared folder when
    the session names one, so lineage stays short and the shuffles of an iteration go with it.
    """
    blocks = blocks or max(4, df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // block_rows))
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        maxIter=iters,
        seed=seed,
        coldStartStrategy=cold_start,
        checkpointInterval=1,
        intermediateStorageLevel="DISK_ONLY",
    )
    # Spark keeps rows back for each pair of blocks, a task's whole input if there are many: so a task gets the users of one block.
    dealt = df.select(user, item, rating).repartitionById(blocks, F.coalesce(F.pmod(F.col(user).cast("int"), F.lit(blocks)), F.lit(0)))
    return als.setNumBlocks(blocks).fit(dealt)


def als_factors(model: ALSModel) -> DataFrame:
    """Both factor tables in one, told apart by ``kind``."""
    users = model.userFactors.select(F.lit("user").alias("kind"), "id", "features")
    items = model.itemFactors.select(F.lit("item").alias("kind"), "id", "features")
    return users.unionByName(items)


def recommend_for_all_users(model: ALSModel, n: int = 10) -> DataFrame:
    """The n best items of each user.  Spark would multiply and rank all pairs; bounds leave most of them out."""
    return best_products(model.userFactors, model.itemFactors, n, model.getUserCol(), model.getItemCol())


def recommend_for_all_items(model: ALSModel, n: int = 10) -> DataFrame:
    """The n best users of each item."""
    return best_products(model.itemFactors, model.userFactors, n, model.getItemCol(), model.getUserCol())


def recommend_for_one(model: ALSModel, id: int, n: int = 10, kind: str = "user") -> DataFrame:
    """Items for one user, or with ``kind="item"`` users for one item."""
    column = model.getUserCol() if kind == "user" else model.getItemCol()
    one = model.userFactors.sparkSession.range(id, id + 1).select(F.col("id").cast("int").alias(column))
    if kind == "user":
        return model.recommendForUserSubset(one, n)
    return model.recommendForItemSubset(one, n)


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Ratings for pairs, in ``prediction``."""
    return model.transform(pairs)


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """RMSE and MSE in one pass."""
    error = F.col(label).cast("double") - F.col(pred).cast("double")
    mse = F.avg(error * error)
    return df.agg(F.sqrt(mse).alias("rmse"), mse.alias("mse"))


def save_load_model(model, path: str):
    """Save and read back a model of any kind."""
    model.write().overwrite().save(path)
    return type(model).load(path)


def term_frequencies(df: DataFrame, col: str = "words", dims: int = 100_000) -> DataFrame:
    """Add hashed term frequencies as ``tf``."""
    return HashingTF(inputCol=col, outputCol="tf", numFeatures=dims).transform(df)


def tfidf_features(df: DataFrame, col: str = "words", dims: int = 100_000) -> DataFrame:
    """Add term frequencies times inverse document frequency as ``features``."""
    counted = term_frequencies(df, col, dims)
    return IDF(inputCol="tf", outputCol="features").fit(counted).transform(counted).drop("tf")


def label_index(df: DataFrame, col: str, mapping: Mapping[str, float] = NEWS_LABELS) -> DataFrame:
    """Add the number of a category as ``label``; rows of other categories are left out."""
    label = F.lit(None).cast("double")
    for name, number in mapping.items():
        label = F.when(F.col(col) == name, float(number)).otherwise(label)
    return df.withColumn("label", label).filter(F.col("label").isNotNull())


def naive_bayes_classify(train: DataFrame, test: DataFrame) -> DataFrame:
    """Multinomial model of ``label`` and ``features``; ``test`` with its prediction."""
    return NaiveBayes(smoothing=1.0).fit(train).transform(test)


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("cnt"))


def multiclass_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows, right predictions and accuracy; ``confusion_counts`` has the matrix."""
    right = F.count_if(F.col(label) == F.col(pred))
    return df.agg(
        F.count(F.lit(1)).alias("cnt"),
        right.alias("correct"),
        F.try_divide(right, F.count(F.lit(1))).alias("accuracy"),
    )


def word2vec_synonyms(
    df: DataFrame,
    col: str,
    word: str,
    n: int = 10,
    seed: int = 42,
    min_count: int = 5,
    partitions: int | None = None,
    driver_words: int = DRIVER_WORDS,
) -> DataFrame:
    """The words nearest to ``word``; ``col`` holds lists of words.

    Spark would train in one task; here it is one for each core unless given.  Spark's trainer has vocabulary and vectors
    on the driver, so it gets no more than ``driver_words`` words that are there ``min_count`` times; with more, all of
    it stays in tables (``word_vectors``), and a task has the vectors of its own texts' words.
    """
    words = df.select(F.explode(col).alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    vocabulary = staged(words.where(F.col("cnt") >= min_count), "vocabulary")
    if vocabulary.count() > driver_words:
        return nearest_words(staged(word_vectors(df, col, vocabulary, seed, partitions), "vectors"), word, n)
    trainer = Word2Vec(inputCol=col, outputCol="vector", minCount=min_count, seed=seed)
    trainer.setNumPartitions(partitions or df.sparkSession.sparkContext.defaultParallelism)
    return trainer.fit(df.select(col)).findSynonyms(word, n)


def news_words(df: DataFrame, col: str) -> DataFrame:
    """Words for ``word2vec_synonyms``: lower case, without commas."""
    words = split_words(F.lower(F.col(col)))
    return df.withColumn("words", F.transform(words, lambda w: F.replace(w, F.lit(","), F.lit(""))))
