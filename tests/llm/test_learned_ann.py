"""Learned partitions: recall against brute force, ties, balance, odd vectors."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import learned_ann as ann


def clustered(n, d=24, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(0, 12, n)] + 0.5 * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def exact(x, ids, queries, top):
    y = x.astype(np.float64)
    out = {}
    for q in queries:
        s = (y[q][None, :] * y).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:top]
        out[int(ids[q])] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def test_parts_are_balanced():
    x = clustered(600).astype(np.float64)
    s = x @ x.T
    graph = (s > np.sort(s, axis=1)[:, [-11]]).astype(np.float32)
    label = ann.balanced_parts(np.maximum(graph, graph.T), 8)
    assert set(np.bincount(label)) == {75}


@pytest.mark.parametrize("blocks", [20_000, 300])
def test_recall_and_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", blocks)
    x = clustered(6000)
    x[100:2100] = x[0]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, part int").repartition(6)
    rows = ann.nearest(df, F.col("vec_id") % 20 == 0, 20, parts=8).collect()
    ids = np.arange(len(x))
    want = exact(x, ids, range(0, 6000, 20), 20)
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    y = x.astype(np.float64)
    assert all(abs(s - y[q] @ y[i]) < 1e-12 for q in got for i, s in got[q])
    assert [i for i, _ in got[200]] == [0, *range(100, 119)]  # copies: smallest ids first


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_the_given_tables_are_routed(spark, monkeypatch, sf):
    """The registered query has several parts, asks some of them, and finds nine in ten neighbours."""
    path = f"/root/testdata/{sf}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    from tallyloom.llm.queries import QUERIES

    routers, fit = [], ann.fit
    monkeypatch.setattr(ann, "fit", lambda sample, parts: routers.append((parts, fit(sample, parts))) or routers[-1][1])
    got = {}
    for r in QUERIES["op3_learned_ann"](spark, path.rsplit("/", 1)[0]).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ((parts, router),) = routers
    assert parts >= 4 and 1 < router.probes < parts
    rows = ann.usable(spark.read.parquet(path)).collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    want = exact(x, ids, np.flatnonzero(ids % 20 == 0), 20)
    assert set(got) == set(want)
    assert sum(len({i for i, _ in want[q]} & got[q]) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_small_and_odd(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, []), (8, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 0, 0.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(df.where("vec_id = 2"), F.col("vec_id") % 20 == 0).count() == 0
