"""Word vectors of a vocabulary that is too large for the driver.

Skip-gram with negative sampling.  As in Spark's ``Word2Vec``, each part of the texts is trained from the same start, and a
word's vector is the average over the parts that have it.  But a part holds only the vectors of its own words, a word's
first vector follows from its hash, and vocabulary and averages stay tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.shared_folder import staged

#: Words of a part, about; a task holds two vectors (800 bytes) for each different one.
PART_WORDS = 4_000_000
#: As Spark has them: length of a vector, words on each side at most, first step.
SIZE, WINDOW, RATE = 100, 5, 0.025
#: Negative samples that a pair counts, those drawn for a batch, words of a batch at most.
NEGATIVES, DRAWN, BATCH = 5, 64, 96
_VECTOR = "word string, vector binary"


def word_vectors(df: DataFrame, col: str, vocabulary: DataFrame, seed: int, partitions: int | None = None) -> DataFrame:
    """``word`` and ``vector``, floats as bytes, of each ``word`` of the vocabulary, which has its count as ``cnt``."""
    total = vocabulary.agg(F.sum("cnt")).first()[0] or 0
    parts = partitions or max(df.sparkSession.sparkContext.defaultParallelism, -(-total // PART_WORDS))
    # Dealt once and written, so that each word of a text is looked up for the part that trains it.
    dealt = df.select(F.col(col).alias("words"), F.floor(F.rand(seed) * parts).cast("int").alias("part")).where(F.size("words") > 0)
    texts = staged(dealt.repartitionById(parts, "part"), "texts")
    own = texts.mapInArrow(_different, "part int, word string").distinct().join(vocabulary, "word")
    own = own.select("part", F.lit(0).alias("kind"), F.xxhash64(F.lit(seed), "word").alias("at"), F.array("word").alias("words"), "cnt")
    texts = texts.select("part", F.lit(1).alias("kind"), F.xxhash64("words").alias("at"), "words", F.lit(0).cast("long").alias("cnt"))
    ordered = own.unionByName(texts).repartitionById(parts, "part").sortWithinPartitions("part", "kind", "at")
    trained = ordered.mapInArrow(_train(total / parts, seed), _VECTOR)
    return trained.repartition("word").sortWithinPartitions("word").mapInArrow(_average, _VECTOR)


def nearest_words(vectors: DataFrame, word: str, n: int) -> DataFrame:
    """``word`` and ``similarity``, the cosine, of the n words nearest to one."""
    one = vectors.where(F.col("word") == word).first()
    if one is None:
        raise ValueError(f"{word} is not in the vocabulary")
    return vectors.where(F.col("word") != word).mapInArrow(_cosines(bytes(one.vector)), "word string, similarity double").orderBy(F.desc("similarity"), "word").limit(n)


def _different(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    for batch in batches:
        part = batch.column("part").to_numpy()
        for p in np.unique(part):
            words = batch.filter(pa.array(part == p)).column("words").flatten().unique().drop_null()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), p, np.int32)), words], ["part", "word"])


def _train(expected: float, seed: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        name, own, part = None, [], None
        for batch in batches:
            parts, kinds = (batch.column(c).to_numpy() for c in ("part", "kind"))
            edges = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if a == b:
                    continue
                if parts[a] != name:
                    if part:
                        yield from part.vectors()
                    name, own, part = parts[a], [], None
                rows = batch.slice(a, b - a)
                if kinds[a] == 0:
                    own.append((rows.column("words").flatten(), rows.column("cnt").to_numpy(), rows.column("at").to_numpy()))
                elif own or part:
                    part, own = part or _Part(own, expected, [seed, int(name)]), []
                    part.train(rows.column("words"))
        if part:
            yield from part.vectors()

    return train


def _first_vectors(hashes):
    """Numbers between -0.5 and 0.5 over the size that follow from the hash of a word."""
    import numpy as np

    out = np.empty((len(hashes), SIZE), np.float32)
    steps = np.arange(1, SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for a in range(0, len(hashes), 10_000):
        x = hashes[a : a + 10_000].astype(np.int64).view(np.uint64)[:, None] + steps
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[a : a + 10_000] = ((x >> np.uint64(40)).astype(np.float32) / np.float32(2**24) - np.float32(0.5)) / SIZE
    return out


class _Part:
    """The words of a part and their vectors."""

    def __init__(self, own: list[tuple], expected: float, seed: list[int]) -> None:
        import numpy as np

        self.words = pa.concat_arrays([x[0] for x in own])
        counts = np.concatenate([x[1] for x in own])
        self.given = _first_vectors(np.concatenate([x[2] for x in own]))
        self.asked = np.zeros_like(self.given)
        self.chances = np.cumsum(counts.astype(np.float64) ** 0.75)
        # In a batch of few different words the steps of each would add up.
        self.batch = min(BATCH, max(8, len(counts) // 4))
        self.random, self.expected, self.seen = np.random.default_rng(seed), max(expected, 1.0), 0

    def train(self, lists: pa.ListArray) -> None:
        import numpy as np
        import pyarrow.compute as pc

        found = pc.index_in(lists.flatten(), value_set=self.words)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        ids = found.fill_null(0).to_numpy()[known]
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        text = np.repeat(np.arange(len(lists)), sizes)[known]
        reach = self.random.integers(1, WINDOW + 1, len(ids))
        for a in range(0, len(ids), self.batch):
            self._step(ids, text, reach, a, min(a + self.batch, len(ids)))

    def _step(self, ids, text, reach, first: int, end: int) -> None:
        """Each word with up to ``WINDOW`` words on each side, fewer by chance; words drawn count against all of them."""
        import numpy as np

        low, high = max(0, first - WINDOW), min(len(ids), end + WINDOW)
        near, middle = ids[low:high], ids[first:end]
        gap = np.abs(np.arange(low, high)[:, None] - np.arange(first, end))
        pairs = ((gap > 0) & (gap <= reach[first:end]) & (text[low:high, None] == text[first:end])).astype(np.float32)
        drawn = np.minimum(np.searchsorted(self.chances, self.random.random(DRAWN) * self.chances[-1], side="right"), len(self.chances) - 1)
        against = pairs.sum(axis=1, keepdims=True) - pairs @ (middle[:, None] == drawn).astype(np.float32)
        rate = np.float32(RATE * max(1e-4, 1 - self.seen / self.expected))
        x, y, z = self.given[near], self.asked[middle], self.asked[drawn]
        right = rate * pairs * _logistic(-(x @ y.T))
        wrong = -rate * np.float32(NEGATIVES / DRAWN) * against * _logistic(x @ z.T)
        share = np.float32(NEGATIVES / DRAWN) * against
        _add(self.given, near, right @ y + wrong @ z, rate * (pairs.sum(axis=1) + DRAWN * share.mean(axis=1)))
        weights = rate * np.concatenate([pairs.sum(axis=0), share.sum(axis=0)])
        _add(self.asked, np.concatenate([middle, drawn]), np.concatenate([right.T @ x, wrong.T @ x]), weights)
        self.seen += end - first

    def vectors(self, size: int = 10_000) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.words), size):
            yield _named(self.words.slice(a, size), self.given[a : a + size])


def _logistic(x):
    import numpy as np

    return 1 / (1 + np.exp(np.clip(-x, -30, 30)))


def _add(table, rows, values, weights) -> None:
    """Adds up the steps of a row.  Together they weigh 1 at most: texts that repeat a word would else throw it far off."""
    import numpy as np

    order = np.argsort(rows, kind="stable")
    sorted_ = rows[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    steps = np.add.reduceat(values[order], first, axis=0)
    table[sorted_[first]] += steps / np.maximum(1, np.add.reduceat(weights[order], first))[:, None]


def _named(words: pa.Array, vectors) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words, pa.array([x.tobytes() for x in vectors], pa.binary())], ["word", "vector"])


def _numbers(column: pa.Array):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, SIZE)


def _average(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of the word; the last word of a batch may go on in the next."""
    import numpy as np

    word, total, count = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column("word")
        runs = words.to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        sums = np.add.reduceat(_numbers(batch.column("vector")).astype(np.float64), first, axis=0)
        counts = np.diff([*first, len(runs)])
        if word == runs[0]:
            sums[0] += total
            counts[0] += count
        elif word is not None:
            yield _named(pa.array([word], pa.string()), (total / count).astype(np.float32)[None])
        word, total, count = runs[-1], sums[-1], counts[-1]
        if len(first) > 1:
            yield _named(words.take(pa.array(first[:-1])), (sums[:-1] / counts[:-1, None]).astype(np.float32))
    if word is not None:
        yield _named(pa.array([word], pa.string()), (total / count).astype(np.float32)[None])


def _cosines(one: bytes) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cosines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        x = np.frombuffer(one, np.float32).astype(np.float64)
        for batch in batches:
            if batch.num_rows:
                vectors = _numbers(batch.column("vector")).astype(np.float64)
                lengths = np.linalg.norm(vectors, axis=1) * np.linalg.norm(x)
                similarity = vectors @ x / np.maximum(lengths, 1e-30)
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(similarity)], ["word", "similarity"])

    return cosines
