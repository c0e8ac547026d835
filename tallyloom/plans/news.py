"""News categories from titles: one test of a model, or a model that is kept for titles to come."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IndexToString
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ml import NEWS_LABELS, label_index, naive_bayes_classify, term_frequencies
from tallyloom.operators.parsing import tokenize_lowercase
from tallyloom.operators.routing import train_test_split
from tallyloom.shared_folder import staged


def classify_news(
    news: DataFrame,
    title: str = "title",
    category: str = "category",
    labels: Mapping[str, float] = NEWS_LABELS,
    dims: int = 100_000,
    seed: int = 42,
) -> DataFrame:
    """Predictions for the test part; weights are fitted on all rows, the model on the training part.

    The term frequencies are staged: weights, model and predictions each read
    them, and the texts are taken apart once.
    """
    labelled = label_index(tokenize_lowercase(news, title), category, labels).withColumn("_key", F.xxhash64(title))
    counted = staged(term_frequencies(labelled, dims=dims).select("label", "_key", "tf"), "terms")
    featured = IDF(inputCol="tf", outputCol="features").fit(counted).transform(counted)
    train, test = train_test_split(featured.select("label", "_key", "features"), seed=seed, by=["_key"])
    return naive_bayes_classify(train, test).select("label", "prediction")


class TitleWords(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The words of a title, as ``tokenize_lowercase`` gives them, as a stage that is saved with its pipeline."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return tokenize_lowercase(dataset, self.getInputCol(), self.getOutputCol())


def fit_news(
    news: DataFrame,
    title: str = "title",
    category: str = "category",
    labels: Mapping[str, float] = NEWS_LABELS,
    dims: int = 100_000,
) -> PipelineModel:
    """Everything from a title to a category as one model: words, frequencies, weights, classes, and names of classes.

    The numbers of the categories are 0, 1, 2, …; rows of other categories are left out.  Null titles have no words.
    """
    names = sorted(labels, key=labels.get)
    if [labels[n] for n in names] != list(range(len(names))):
        raise ValueError("categories are numbered from 0 without gaps")
    stages = [
        TitleWords(inputCol=title, outputCol="words"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=dims),
        IDF(inputCol="tf", outputCol="features"),
        NaiveBayes(smoothing=1.0),
        IndexToString(inputCol="prediction", outputCol="predicted_category", labels=names),
    ]
    labelled = label_index(news.select(F.coalesce(title, F.lit("")).alias(title), category), category, labels)
    return Pipeline(stages=stages).fit(labelled.select(title, "label"))


def load_news(path: str) -> PipelineModel:
    """A model that ``fit_news(...).write().save(path)`` left."""
    return PipelineModel.load(path)


def classify_titles(model: PipelineModel, titles: DataFrame, title: str = "title") -> DataFrame:
    """The titles, with all their columns, and the category that the model gives each."""
    filled = titles.withColumn("_given", F.col(title)).withColumn(title, F.coalesce(title, F.lit("")))
    found = model.transform(filled).withColumn(title, F.col("_given"))
    return found.select(*titles.columns, "predicted_category")
