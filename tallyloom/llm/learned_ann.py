"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors gives a neighbour graph; the graph is cut into parts of equal size with few cut edges;
a small network learns which parts hold a vector's neighbours.  It then deals every vector of the table to its most
probable part and every query to several.  Within a part, queries and vectors meet in blocks of bounded size, and the
candidates found are scored again in double precision on the original vectors.

Only the sample (``SAMPLE`` vectors), the network and the sizes of the parts are ever on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.shared_folder import staged

SAMPLE = 4_096
GRAPH_NEIGHBOURS = 20
#: Vectors of a part, on average: about what one task holds.  There are ``MIN_PARTS`` parts at least, as long as each has
#: ``LEAST_ROWS`` vectors, and ``MAX_PARTS`` at most.
PART_ROWS = 20_000
LEAST_ROWS = 25
MIN_PARTS, MAX_PARTS = 16, 128
HIDDEN = 64
STEPS = 200
#: Recall of the neighbours in the sample that the number of probed parts must reach there.
SAMPLE_RECALL = 0.94
BLOCK_VECTORS = 20_000
BLOCK_QUERIES = 4_000


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """A part for every node of a symmetric weight matrix: halves of halves, each refined by swaps.

    A half is cut at the median of the second eigenvector, so sizes differ by one at most in each cut.
    """
    label = np.zeros(len(graph), np.int64)

    def split(nodes: np.ndarray, count: int, first: int) -> None:
        if count == 1:
            label[nodes] = first
            return
        inner = graph[np.ix_(nodes, nodes)]
        degree = inner.sum(axis=1) + 1e-9
        x = np.cos(np.arange(len(nodes)) * 2.399963)
        for _ in range(60):
            x = x - (x * degree).sum() / degree.sum()
            x = 0.5 * x + 0.5 * (inner @ x) / degree
            x /= np.abs(x).max() + 1e-30
        left_count = count // 2
        size = len(nodes) * left_count // count
        side = np.zeros(len(nodes), bool)
        side[np.argsort(x, kind="stable")[:size]] = True
        for _ in range(10):
            to_left = inner @ side
            gain = np.where(side, degree - 2 * to_left, 2 * to_left - degree)  # what moving a node would save
            out, into = np.flatnonzero(side), np.flatnonzero(~side)
            out, into = out[np.argsort(-gain[out])], into[np.argsort(-gain[into])]
            k = min(len(out), len(into), max(1, len(nodes) // 50))
            good = (gain[out[:k]] + gain[into[:k]]) > 1e-9
            if not good.any():
                break
            before = inner[side][:, ~side].sum()
            side[out[:k][good]], side[into[:k][good]] = False, True
            if inner[side][:, ~side].sum() >= before:
                side[out[:k][good]], side[into[:k][good]] = True, False
                break
        split(nodes[side], left_count, first)
        split(nodes[~side], count - left_count, first + left_count)

    split(np.arange(len(graph)), parts, 0)
    return label


class Router:
    """A network with one hidden layer: probabilities of the parts for a vector."""

    def __init__(self, scale: float, weights: list[np.ndarray], probes: int) -> None:
        self.scale, self.weights, self.probes = scale, weights, probes

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(x * self.scale @ a + b, 0) @ c + d

    def order(self, x: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts, best first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :count]


def _trained(x: np.ndarray, target: np.ndarray) -> Router:
    rng = np.random.default_rng(7)
    scale = 1.0 / (np.sqrt((x**2).mean()) + 1e-30)
    z = x * scale
    parts = target.shape[1]
    w = [rng.normal(0, math.sqrt(2 / z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, math.sqrt(2 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for step in range(1, STEPS + 1):
        hidden = np.maximum(z @ w[0] + w[1], 0)
        logits = hidden @ w[2] + w[3]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) / len(z)
        back = (error @ w[2].T) * (hidden > 0)
        for i, g in enumerate((z.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            w[i] -= 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(scale, w, 1)


def fit(sample: np.ndarray, parts: int) -> Router:
    """A router from a sample: neighbour graph, balanced parts, network, and the number of parts to probe."""
    n = len(sample)
    if parts <= 1 or n <= 2 * parts:
        d = sample.shape[1] if n else 1
        return Router(1.0, [np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    k = min(GRAPH_NEIGHBOURS, n - 1)
    near = np.empty((n, k), np.int64)
    for a in range(0, n, 256):  # in blocks: all scores at once would be the driver's largest table
        score = -(sample[a : a + 256] @ sample.T)
        score[np.arange(len(score)), np.arange(a, a + len(score))] = np.inf
        near[a : a + 256] = np.argpartition(score, k - 1, axis=1)[:, :k]
    graph = np.zeros((n, n), np.float32)
    graph[np.arange(n)[:, None], near] = 1
    graph = np.maximum(graph, graph.T)
    label = balanced_parts(graph, parts)
    target = np.zeros((n, parts))
    np.add.at(target, (np.arange(n)[:, None], label[near]), 1.0 / (k + 1))
    target[np.arange(n), label] += 1.0 / (k + 1)
    router = _trained(sample, target)
    # Rows go where the network sends them, so recall is measured with these parts and not with those of the graph.
    order = router.order(sample, parts)
    home = order[:, 0]
    rank_of = np.empty_like(order)
    np.put_along_axis(rank_of, order, np.arange(parts)[None, :], axis=1)
    found = np.take_along_axis(rank_of, home[near], axis=1)
    shares = [(found < t).mean() for t in range(1, parts + 1)]
    router.probes = 1 + next(i for i, s in enumerate(shares) if s >= SAMPLE_RECALL or i == parts - 1)
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part.

    Left out are null ids, null or empty vectors, vectors with null or non-finite components, zero vectors, and
    vectors whose length is not the commonest one.
    """
    e = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where("vec_id is not null and embedding is not null and size(embedding) > 0")
    fine = fine.where(finite & F.exists("embedding", lambda x: x != 0))
    common = fine.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("embedding") == (common.n if common else 0))


def _routed(router: Router, probes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            parts = router.order(flat.reshape(batch.num_rows, -1), probes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=["vec_id", "embedding", "parts"])

    return run


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, 1))


FOUND = "query_id long, vec_id long, score double"


def _block(top: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        vectors = vectors.sort_values("vec_id", kind="stable")
        ids, c = vectors["vec_id"].to_numpy(np.int64), _matrix(vectors["embedding"])
        # Of equal vectors only the smallest ids can be among the nearest: ties go to them.
        key = np.ascontiguousarray(c).view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel()
        group = np.unique(key, return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        sorted_group = group[order]
        head = np.r_[True, sorted_group[1:] != sorted_group[:-1]]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        # The query itself and repeated rows of one id may take places in vain.
        keep = np.sort(order[place < top + 1]) if len(np.unique(ids)) == len(ids) else np.arange(len(ids))
        ids, c = ids[keep], c[keep]
        qids, q = queries["vec_id"].to_numpy(np.int64), _matrix(queries["embedding"])
        out_q, out_v, out_s = [], [], []
        for a in range(0, len(q), 256):
            scores = q[a : a + 256] @ c.T
            for i, row in enumerate(scores):
                row[ids == qids[a + i]] = -np.inf
                k = min(len(row), top)
                bar = np.partition(row, len(row) - k)[len(row) - k]
                if bar == -np.inf:
                    near = np.flatnonzero(row > -np.inf)
                else:
                    near = np.flatnonzero(row >= bar - 1e-9 * (1 + abs(bar)))
                exact = (q[a + i][None, :] * c[near]).sum(axis=1)
                best = np.lexsort((ids[near], -exact))
                chosen: dict[int, float] = {}
                for j in best.tolist():
                    chosen.setdefault(int(ids[near[j]]), float(exact[j]))
                    if len(chosen) == top:
                        break
                out_q += [int(qids[a + i])] * len(chosen)
                out_v += list(chosen)
                out_s += list(chosen.values())
        return pd.DataFrame({"query_id": np.array(out_q, np.int64), "vec_id": np.array(out_v, np.int64), "score": np.array(out_s)})

    return run


def _searched(index: DataFrame, queries: DataFrame, sizes: dict[int, int], loads: dict[int, int], top: int) -> DataFrame:
    """The best of each block for each query: parts are cut into blocks by hash of the id, on both sides."""
    cuts = {p: (math.ceil(loads.get(p, 0) / BLOCK_QUERIES) or 1, math.ceil(n / BLOCK_VECTORS) or 1) for p, n in sizes.items()}
    lookup = F.create_map(*(F.lit(x) for p, (a, b) in cuts.items() for x in (p, (a << 20) + b)))
    both = lambda df, salt: df.withColumn("cut", lookup[F.col("part")]).withColumns({"q_cuts": F.shiftright("cut", 20), "v_cuts": F.col("cut").bitwiseAND((1 << 20) - 1)})  # noqa: E731, ARG005
    q = both(queries, 1).where("cut is not null").withColumn("q_cut", F.pmod(F.xxhash64("vec_id"), "q_cuts").cast("int")).withColumn("v_cut", F.explode(F.sequence(F.lit(0), F.col("v_cuts") - 1)))
    v = both(index, 2).withColumn("v_cut", F.pmod(F.xxhash64("vec_id", F.lit(1)), "v_cuts").cast("int")).withColumn("q_cut", F.explode(F.sequence(F.lit(0), F.col("q_cuts") - 1)))
    keys = ["part", "q_cut", "v_cut"]
    q, v = q.select(*keys, "vec_id", "embedding"), v.select(*keys, "vec_id", "embedding")
    return q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(_block(top), FOUND)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def parts_for(total: int) -> int:
    """How many parts a table has: a power of two."""
    if total < MIN_PARTS * LEAST_ROWS:
        return 1
    return min(MAX_PARTS, max(MIN_PARTS, 1 << max(0, math.ceil(math.log2(total / PART_ROWS)))))


def nearest(vectors: DataFrame, is_query: F.Column, top: int = 20, parts: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` rows with the largest inner product found for each query row.

    Ties go to the smaller vec_id; a row is not its own neighbour, nor are rows with the same vec_id; of repeated
    vec_ids the best score counts.  A query for which the probed parts hold fewer than ``top`` rows is searched for in
    all parts.  `usable` says which rows take part.
    """
    rows = usable(vectors)
    sample_rows = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()
    sample = np.array([r.embedding for r in sample_rows]) if sample_rows else np.zeros((0, 1))
    total = rows.count() if len(sample) == SAMPLE else len(sample)
    router = fit(sample, parts or parts_for(total))
    kind = "vec_id long, embedding array<double>, parts array<int>"
    index = staged(rows.mapInArrow(_routed(router, 1), kind).select(F.col("parts")[0].alias("part"), "vec_id", "embedding"), "index")
    sizes = {r.part: r["count"] for r in index.groupBy("part").count().collect()}  # a row for each part
    asked = staged(rows.where(is_query).mapInArrow(_routed(router, router.probes), kind).select(F.explode("parts").alias("part"), "vec_id", "embedding"), "queries")
    loads = {r.part: r["count"] for r in asked.groupBy("part").count().collect()}
    if not sizes:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = staged(_searched(index, asked, sizes, loads, top), "found")
    ranked = _ranked(found, top)
    few = asked.select(F.col("vec_id").alias("query_id")).distinct().join(found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")), "query_id", "left").where(F.coalesce("n", F.lit(0)) < min(top, total - 1))
    few = staged(few.select(F.col("query_id").alias("vec_id")), "few")
    missing = few.count()
    if not missing or router.probes >= len(sizes):
        return ranked
    everywhere = asked.dropDuplicates(["vec_id"]).drop("part").join(few, "vec_id").withColumn("part", F.explode(F.array(*(F.lit(p) for p in sorted(sizes)))))
    rest = _searched(index, everywhere, sizes, dict.fromkeys(sizes, missing), top)
    return _ranked(found.unionByName(rest), top)
