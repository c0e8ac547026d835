"""Checksums of spans, weights and the draw, against plain loops over the same rows."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import resampling, spans


@pytest.mark.parametrize("n", [0, 1, 7, 1023, 1024, 1025, 4096, 70_001, (1 << 20) - 1, 1 << 20, (1 << 20) + 1, (2 << 20) + 5])
def test_long_spans(n):
    data = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
    assert spans.long_crc(data) == zlib.crc32(data.tobytes())


def runs(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


TEXTS = [
    "The cat sat on the mat, the CAT sat!",
    "",
    None,
    "...",
    "one",
    "zwei wörter",
    "ÄÖÜ İI ſ K ß 12-34_56",
    "x" * 900 + " " + "y" * 200 + " z " + "é" * 700 + " end",
    "w " * 30_000,
    "\x00a\x00b\x7fc d e f",
    *(" ".join(f"w{(i * j) % 17}" for j in range(3 + i)) for i in range(60)),
    " ".join(f"w{j % 5}" for j in range(40)),
    " ".join(f"w{j % 5}" for j in range(40)),
]
TARGET = ["w1 w2 w3 w4", "the mat", None, "w0 w0"]


def expected(rows, target, percent=5, min_words=20):
    s, t = [0] * 10_000, [0] * 10_000
    for _, text in rows:
        for f in runs(text)[1]:
            s[zlib.crc32(f.encode()) % 10_000] += 1
    for text in target:
        for f in runs(text)[1]:
            t[zlib.crc32(f.encode()) % 10_000] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (all_s + 10_000) / ((a + 1) * (all_t + 10_000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for doc_id, text in rows:
        words, features = runs(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in features)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    fit = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(fit[: percent * len(fit) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_equals_loops(spark, rows, percent):
    given = list(enumerate(TEXTS)) + [(1000 + i, " ".join(f"w{j % 5}" for j in range(25))) for i in range(20)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in given], "doc_id long, text string, score long, rank long").repartition(5)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    found = resampling.resample(docs, target, percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(found) == sorted(expected(given, TARGET, percent), key=repr)


def test_repeated_rows_and_missing_ids_have_places_of_their_own(spark):
    text = " ".join(f"w{j % 5}" for j in range(25))
    docs = spark.createDataFrame([(7, text)] * 30 + [(None, text)] * 30, "doc_id long, text string")
    found = resampling.resample(docs, docs, percent=50).collect()
    assert len(found) == 60 and sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 31))
    assert len({r.score for r in found}) == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = docs.where("false")
    assert resampling.resample(none, docs).count() == 0
    assert resampling.resample(docs, none.select("text")).where(F.col("rank").isNotNull()).count() == 0


def test_groups_of_texts_do_not_change_the_counts(monkeypatch, spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").coalesce(1)
    whole = rows(resampling.bucket_counts(docs))
    column = docs.select(F.concat(F.coalesce("text", F.lit("")), F.lit(" ")).alias("text")).toArrow().column(0).combine_chunks()
    for size, words in ((1, 1), (300, 7), (5000, 100)):
        monkeypatch.setattr(resampling, "CHUNK_BYTES", size)
        monkeypatch.setattr(resampling, "CHUNK_WORDS", words)
        total = np.zeros(10_000, np.int64)
        for data, offsets in resampling._texts(column):
            for _, buckets, there in resampling._features(data, offsets)[1]:
                total += np.bincount(buckets[there], minlength=10_000)
        assert [(int(b), int(total[b])) for b in np.flatnonzero(total)] == sorted(whole)
