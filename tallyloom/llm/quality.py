"""Quality scores from supervised subword embeddings.

Words, pairs of words and character n-grams are hashed to vectors; a text is the average of the vectors of all its
features; a linear layer and softmax give the probability of each label.  Vectors and layer are learned together by
stochastic gradient descent, one text at a time.

Learning takes rounds.  The labelled rows are dealt to a fixed number of shards; in a round each shard is a task that
starts from the same model and goes through its texts in a fixed order, and the models are averaged by the number of
texts.  Few labelled rows are gone through more often, so that a round takes about ``STEPS`` steps.  A task that is run
again gives the same model.  Of more than ``max_labelled`` labelled documents about that
many are used, chosen by a hash of doc_id.  The size of a model does not depend on the data; rounds x shards models
come to the driver, one at a time for each shard.

Scoring needs one number a feature.  Scores depend on the text alone, so repeated rows score alike; a null or empty text
has no features and gets what the labels say of a text unseen.  A doc_id with several labels counts as what most of them
say (ties: 1), and one with several texts is learned from with the one whose hash is smallest.  Labels that are null or
have no doc_id, labelled null texts and other columns are ignored.  Without labels every score is 0.5.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import subwords
from tallyloom.shared_folder import staged

MAX_LABELLED = 8_000
DIMENSIONS = 8
SHARDS = 4
ROUNDS = 3
#: Steps of a round over all shards, and how often it goes through a text at most.
STEPS, MAX_PASSES = 8_000, 40
RATE = 3.0
THRESHOLD = 0.7


class Model:
    """Vectors of features, and the layer that turns an average of them into two scores."""

    def __init__(self, vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray) -> None:
        self.vectors, self.layer, self.bias = vectors, layer, bias

    @classmethod
    def fresh(cls, bits: int = subwords.BITS, dimensions: int = DIMENSIONS) -> Model:
        drawn = np.random.default_rng(42).random((1 << bits, dimensions), np.float32)
        return cls((drawn - 0.5) / dimensions, np.zeros((2, dimensions), np.float32), np.zeros(2, np.float32))

    def pack(self) -> bytes:
        return np.concatenate([self.layer.ravel(), self.bias, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpack(cls, data: bytes, dimensions: int = DIMENSIONS) -> Model:
        flat = np.frombuffer(data, np.float32).copy()
        layer, bias, vectors = np.split(flat, [2 * dimensions, 2 * dimensions + 2])
        return cls(vectors.reshape(-1, dimensions), layer.reshape(2, dimensions), bias)

    def learn(self, numbers: np.ndarray, share: np.ndarray, label: int, rate: float) -> None:
        """One step on one text: the distinct features with their shares of all features."""
        rows = self.vectors[numbers]
        mean = share @ rows
        z = self.layer @ mean + self.bias
        error = np.exp(z - z.max())
        error /= error.sum()
        error[label] -= 1
        back = error @ self.layer
        self.layer -= rate * np.outer(error, mean)
        self.bias -= 0.1 * rate * error
        self.vectors[numbers] = rows - rate * share[:, None] * back

    def margins(self) -> np.ndarray:
        """What each feature adds to the difference of the two scores; the last entry is that of the biases."""
        return np.append(self.vectors @ (self.layer[1] - self.layer[0]), self.bias[1] - self.bias[0]).astype(np.float64)


def _shares(texts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text: distinct features and their shares."""
    numbers, owners = subwords.features(texts, bits)
    keys, counts = np.unique(owners.astype(np.int64) << bits | numbers, return_counts=True)
    cuts = np.searchsorted(keys >> bits, np.arange(len(texts) + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield (keys[a:b] & ((1 << bits) - 1)).astype(np.int32), (counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32)


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(key, text, label) of the labelled documents that are learned from; one row a doc_id.

    The labels are counted and bounded before they meet the documents, so the side that is joined is small.
    """
    marks = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(target).cast("int").alias("label"))
    voted = staged(marks.groupBy("doc_id").agg((2 * F.sum("label") >= F.count("*")).cast("int").alias("label")), "labels")
    share = max_labelled / max(1, voted.count())
    key = F.xxhash64("doc_id", F.lit(11))
    if share < 1:
        voted = voted.where(F.pmod(key, F.lit(1_000_000)) < int(1_000_000 * share))
    voted = staged(voted, "chosen")
    joined = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(voted), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    return staged(joined.groupBy("doc_id", "label").agg(one).select(key.alias("key"), "text", "label"), "labelled")


def _by_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[Iterator[tuple[list[str], list[int]]]]:
    """The texts and labels of each shard in turn, a part at a time; a partition holds whole shards, one after the other."""

    def parts() -> Iterator[tuple[int, list[str], list[int]]]:
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in itertools.pairwise(cuts):
                if b > a:
                    rows = batch.slice(a, b - a)
                    yield int(shards[a]), rows.column("text").to_pylist(), rows.column("label").to_pylist()

    for _, group in itertools.groupby(parts(), key=lambda part: part[0]):
        yield ((texts, labels) for _, texts, labels in group)


def _steps(parts: Iterable[tuple[list[str], list[int]]], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    for texts, labels in parts:
        for a, b in subwords.grouped(texts):
            for (numbers, share), label in zip(_shares(texts[a:b], bits), labels[a:b], strict=True):
                yield numbers, share, label


def train(
    labelled: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, rate: float = RATE, bits: int = subwords.BITS, dimensions: int = DIMENSIONS
) -> Model | None:
    """A model from a bounded number of rows (key, text, label); none without rows."""
    total = labelled.count()
    if not total:
        return None
    context = labelled.sparkSession.sparkContext
    model = Model.fresh(bits, dimensions)
    passes = max(1, min(MAX_PASSES, STEPS // total))
    dealt = labelled.withColumn("shard", F.pmod("key", F.lit(shards)))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "key", "label")
    for turn in range(rounds):
        sent = context.broadcast(model.pack())
        step = rate * (1 - turn / rounds)

        def run(batches: Iterable[pa.RecordBatch], sent=sent, step=step) -> Iterator[pa.RecordBatch]:
            for texts in _by_shard(batches):
                own, n, again = Model.unpack(sent.value, dimensions), 0, []
                for numbers, share, label in _steps(texts, bits):
                    own.learn(numbers, share, label, step)
                    n += 1
                    if passes > 1:
                        again.append((numbers, share, label))
                for _ in range(passes - 1):
                    for numbers, share, label in again:
                        own.learn(numbers, share, label, step)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([own.pack()], pa.binary())], names=["n", "model"])

        mean: np.ndarray | float = 0.0
        for r in sorted(dealt.mapInArrow(run, "n long, model binary").collect()):
            mean = mean + np.float32(r["n"] / total) * np.frombuffer(r["model"], np.float32)
        model = Model.unpack(mean.tobytes(), dimensions)
        sent.unpersist()
    return model


def score_documents(docs: DataFrame, model: Model | None, bits: int = subwords.BITS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row."""
    margins = np.zeros((1 << bits) + 1) if model is None else model.margins()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            scores: list[float] = []
            for a, b in subwords.grouped(texts):
                numbers, owners = subwords.features(texts[a:b], bits)
                counts = np.maximum(1, np.bincount(owners, minlength=b - a))
                means = np.bincount(owners, margins[numbers], minlength=b - a) / counts + margins[-1]
                scores += [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in means.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))
