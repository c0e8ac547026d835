"""Importance resampling: documents that look like a target collection are drawn more often.

Features are hashed runs of one to three words.  What a bucket gains is the logarithm of how much more frequent it is
in the target than in the documents; a document's weight is the sum of its features' gains, and a draw without
replacement takes the highest weights after a noise that depends on the identifier alone has been added.

Words are cut out of the UTF-8 bytes: only ASCII has bytes that are no part of a word, so bytes decide as characters
do.  Checksums of all runs of a batch come from ``spans.run_crcs``.  Both passes read the texts; what crosses the
network is a count for each bucket and task, and one short row a document for the draw.

Null and empty texts have no features and weight 0.  Rows without an identifier take part with the noise of an empty
one; among equal scores they come last.  Equal rows keep apart; each has a place of its own.  Other columns of the
input are ignored.  An empty table gives an empty result; with an empty target every bucket is as good as its rarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import spans
from tallyloom.shared_folder import staged

BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
SEED = 42
#: Texts that are worked on together have about this many bytes, or are one text.
CHUNK_BYTES = 2 << 20
#: Words whose runs are summed together.
CHUNK_WORDS = 50_000


def _word_bytes() -> np.ndarray:
    """Every byte as it stands in a word, or as a blank."""
    table = np.full(256, 0x20, np.uint8)
    for lo, hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[lo : hi + 1] = np.arange(lo, hi + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_WORD_BYTES = _word_bytes()


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of groups of texts; every text ends with a blank."""
    size = 64 if pa.types.is_large_string(column.type) else 32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, f"int{size}")[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        yield data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """The first word of each text (and of the end), and blocks of (first word, buckets, which of them exist)."""
    plain = _WORD_BYTES[data]
    inside = plain != 0x20
    after = np.zeros(len(inside), bool)
    after[1:] = inside[:-1]
    bounds = np.searchsorted(np.flatnonzero(inside & ~after), offsets)
    text = plain[inside | after]
    ends = np.flatnonzero(text == 0x20)
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(ends) else ends
    first = np.repeat(bounds[:-1], np.diff(bounds))

    def blocks() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for a in range(0, len(ends), CHUNK_WORDS):
            b = min(len(ends), a + CHUNK_WORDS)
            there = np.arange(a, b)[:, None] - np.arange(3)[None, :] >= first[a:b, None]
            yield a, spans.run_crcs(text, starts, ends, first, a, b) % np.uint32(BUCKETS), there

    return bounds, blocks()


def _padded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.concat(F.coalesce("text", F.lit("")), F.lit(" ")).alias("text"))


def bucket_counts(df: DataFrame) -> DataFrame:
    """(bucket, n): the features of all texts, counted in each task first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data, offsets in _texts(batch.column(0)):
                for _, buckets, there in _features(data, offsets)[1]:
                    total += np.bincount(buckets[there], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return _padded(df).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """What each bucket adds to a weight, in thousandths.  One number a bucket comes to the driver."""
    counts = bucket_counts(docs).withColumn("at", F.lit(0)).unionByName(bucket_counts(target).withColumn("at", F.lit(1)))
    n = np.zeros((2, BUCKETS), np.int64)
    for r in counts.collect():
        n[r["at"], r["bucket"]] = r["n"]
    all_s, all_t = (float(x) + BUCKETS for x in n.sum(axis=1))
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in n.T.tolist()], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, weights = [], []
            for data, offsets in _texts(batch.column(1)):
                bounds, blocks = _features(data, offsets)
                sums = np.zeros(bounds[-1] + 1, np.int64)
                for a, buckets, there in blocks:
                    sums[a + 1 : a + 1 + len(buckets)] = np.where(there, gains[buckets], 0).sum(axis=1)
                sums = np.cumsum(sums)
                words.append(np.diff(bounds))
                weights.append(sums[bounds[1:]] - sums[bounds[:-1]])
            n = np.concatenate(words) if words else np.zeros(0, np.int64)
            features = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
            weight = np.concatenate(weights) if weights else n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _padded(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: str = "doc_id", seed: int = SEED) -> F.Column:
    """Gumbel noise in thousandths, fixed for an identifier."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _numbered(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = 0
    for batch in rows:
        place = pa.array(np.arange(seen + 1, seen + 1 + len(batch)), pa.int64())
        seen += len(batch)
        yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*batch.schema.names, "place"])


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Rank the highest scores, ``percent`` of the rows with ``min_words`` words or more; the others have none.

    Rows are ordered by ranges, so no task orders all of them.  A rank is the place within a range plus the lengths of
    the ranges before it; one number a range comes to the driver.
    """
    rows = staged(scored.withColumns({"in_draw": F.col("n_words") >= min_words, "row_id": F.monotonically_increasing_id()}), "scores")
    order = [F.desc("in_draw"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row_id")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("span", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    placed = staged(ordered.mapInArrow(_numbered, f"{schema}, place long"), "places")
    sizes = sorted(placed.where("in_draw").groupBy("span").agg(F.count("*").alias("n")).collect())
    n = sum(r["n"] for r in sizes)
    before = np.cumsum([0, *(r["n"] for r in sizes)])[:-1].tolist()
    spark = scored.sparkSession
    shifts = spark.createDataFrame([(r["span"], b) for r, b in zip(sizes, before, strict=True)], "span int, before long")
    rank = F.col("place") + F.col("before")
    drawn = F.col("in_draw") & (rank <= percent * n // 100)
    return placed.join(shifts, "span", "left").select("doc_id", "n_features", "weight", "score", F.when(drawn, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every row of ``docs``."""
    found = weighted(docs, bucket_gains(docs, target))
    return draw(found.withColumn("score", F.col("weight") + noise(seed=seed)), percent, min_words)


#: The byte table is made from its rule; checksums of the distinct features follow byte by byte.
SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT b, b AS c, 0 AS step FROM range(256) AS r(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, {spans.POLYNOMIAL}::BIGINT) ELSE c >> 1 END, step + 1 FROM steps WHERE step < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM steps WHERE step = 8),
texts AS (
  SELECT 0 AS side, doc_id, row_number() OVER () AS row_id, text FROM documents
  UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
worded AS (
  SELECT side, doc_id, row_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
placed AS (SELECT side, row_id, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
grams AS (
  SELECT side, row_id, array_to_string(words[i : i + k - 1], ' ') AS gram
  FROM placed, range(1, 4) AS r(k) WHERE i + k - 1 <= len(words)),
distinct_grams AS (SELECT DISTINCT gram FROM grams),
hexed AS (SELECT gram, hex(encode(gram)) AS h FROM distinct_grams),
buckets AS (
  SELECT gram, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda n: ('0x' || h[2 * n + 1 : 2 * n + 2])::BIGINT),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295::BIGINT) % {BUCKETS} AS bucket
  FROM hexed, crc),
counted AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
  FROM grams JOIN buckets USING (gram) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counted),
weights AS (
  SELECT row_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM grams JOIN buckets USING (gram) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row_id),
scored AS (
  SELECT doc_id, len(words) AS n, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM worded LEFT JOIN weights USING (row_id) WHERE side = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (n >= {MIN_WORDS}) OVER () AS total FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n >= {MIN_WORDS} AND place <= {PERCENT} * total // 100 THEN place END AS rank FROM ranked
"""
