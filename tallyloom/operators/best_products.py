"""The largest inner products of each vector with the vectors of another table, exactly.

All pairs count, but most are left out by bounds.  The other vectors are dealt to cells of like length and direction;
with a the part of a vector along its cell's direction and b the length of the rest, no product of x with the cell is
above (x along it) * a + (rest of x) * b at the largest a and b.  A cell is multiplied only with the vectors
for which that bound reaches their n-th best product so far, the longest vectors first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.shared_folder import staged

#: Vectors that a task looks for; it holds them and their best products, about 300 bytes each.
GROUP = 250_000
#: Vectors of a cell at most, cells that are looked at together, vectors that are multiplied with a cell at once.
CELL, CELLS, TILE = 128, 128, 8192
#: Products that wait to be merged at most, unless one block has more.
WAITING = 300_000
#: Share of the largest product that rounding may cost.
SLACK = 1e-5
_PACKED = "part int, kind int, longest double, at long, ids binary, vectors binary"


def best_products(left: DataFrame, right: DataFrame, n: int, id: str, other: str, group: int = GROUP) -> DataFrame:
    """``id`` and ``recommendations``, the n largest (``other``, rating) of each vector; of equal ratings the larger number first, as Spark does.

    Both tables have an int ``id`` that is there once, and ``features``, arrays of floats of one length.  The vectors of
    ``right`` go to each group of ``left``, packed; a task reads them in order and holds none but those of a batch.
    """
    spark = left.sparkSession
    cores = spark.sparkContext.defaultParallelism
    left, right = (staged(x.select("id", "features"), "vectors") for x in (left, right))
    groups = max(1, min(left.count(), max(2 * cores, -(-left.count() // group))))
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x))
    # Cells are made once and written, so that each group reads the same ones.
    ranged = right.withColumn("longest", length).repartitionByRange(max(cores, right.count() // 100_000), F.desc("longest"))
    cells = staged(ranged.sortWithinPartitions(F.desc("longest"), "id").mapInArrow(_cells, _PACKED), "cells")
    wanted = left.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).mapInArrow(_by_part, _PACKED)
    dealt = wanted.unionByName(cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    ordered = dealt.repartitionById(groups, "part").sortWithinPartitions("part", "kind", F.desc("longest"), "at")
    return ordered.mapInArrow(_search(n, other), f"id int, recommendations array<struct<{other}:int,rating:float>>").withColumnRenamed("id", id)


def _arrays(batch: pa.RecordBatch):
    import numpy as np

    ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int32)
    return ids, batch.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(ids), -1)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "kind", "longest", "at", "ids", "vectors"])


def _by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors of a batch that go to one group, in one row."""
    import numpy as np

    for batch in batches:
        if batch.num_rows:
            ids, vectors = _arrays(batch)
            part = batch.column("part").to_numpy()
            order = np.argsort(part, kind="stable")
            names, first = np.unique(part[order], return_index=True)
            yield _packed([(int(p), 0, 0.0, 0, ids[o].tobytes(), vectors[o].tobytes()) for p, o in zip(names, np.split(order, first[1:]), strict=True)])


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of vectors of like length as cells of like direction, a row each, under the length of the longest."""
    for batch in batches:
        if batch.num_rows:
            ids, vectors = _arrays(batch)
            longest = float(batch.column("longest")[0].as_py())
            yield _packed([(0, 1, longest, at, ids[o].tobytes(), vectors[o].tobytes()) for at, o in enumerate(_halves(vectors))])


def _halves(vectors) -> Iterator:
    """Cut in halves along the widest axis of the directions, until a part is a cell."""
    import numpy as np

    directions = _directions(vectors)
    parts = [np.arange(len(vectors))]
    while parts:
        part = parts.pop()
        if len(part) <= CELL:
            yield part
            continue
        half = len(part) // 2
        values = directions[part]
        order = np.argpartition(values[:, values.var(axis=0).argmax()], half)
        parts += [part[order[half:]], part[order[:half]]]


def _directions(vectors):
    import numpy as np

    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), np.float32(1e-30))


def _search(n: int, other: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, wanted, best = None, [], None
        for batch in batches:
            parts, kinds = (batch.column(c).to_numpy() for c in ("part", "kind"))
            ids, vectors = batch.column("ids"), batch.column("vectors")
            at = 0
            while at < batch.num_rows:
                if parts[at] != part:
                    if best or wanted:
                        yield from (best or _Best(wanted, n)).lists(other)
                    part, wanted, best = parts[at], [], None
                same = (parts[at : at + CELLS] == part) & (kinds[at : at + CELLS] == kinds[at])
                end = at + (len(same) if same.all() else int(same.argmin()))
                rows = [(ids[i].as_buffer(), vectors[i].as_buffer()) for i in range(at, end)]
                if kinds[at] == 0:
                    wanted += [(bytes(a), bytes(b)) for a, b in rows]
                elif wanted or best:
                    best, wanted = best or _Best(wanted, n), []
                    best.look(rows)
                at = end
        if best or wanted:
            yield from (best or _Best(wanted, n)).lists(other)

    return search


def _matrix(rows: list[tuple]):
    """Numbers and vectors of packed rows, and where each row begins."""
    import numpy as np

    ids = [np.frombuffer(a, np.int32) for a, _ in rows]
    vectors = np.concatenate([np.frombuffer(b, np.float32).reshape(len(a), -1) for a, (_, b) in zip(ids, rows, strict=True)])
    return np.concatenate(ids), vectors, np.cumsum([0, *map(len, ids)])


class _Best:
    """Vectors, and the largest products of each so far."""

    def __init__(self, rows: list[tuple], n: int) -> None:
        import numpy as np

        self.n = n
        self.ids, self.vectors, _ = _matrix(rows)
        self.lengths = np.linalg.norm(self.vectors, axis=1)
        self.products = np.full((len(self.ids), n), -np.inf, np.float32)
        self.others = np.full((len(self.ids), n), -1, np.int32)
        self.least = np.full(len(self.ids), -np.inf, np.float32)
        self.begun = False

    def look(self, rows: list[tuple]) -> None:
        import numpy as np

        ids, vectors, starts = _matrix(rows)
        cells, sizes = starts[:-1], np.diff(starts)
        lengths = np.linalg.norm(vectors, axis=1)
        if not self.begun:
            self._begin(vectors, lengths)
        slack = np.float32(SLACK) * self.lengths * lengths.max()
        active = np.flatnonzero(self.lengths * lengths.max() + slack >= self.least)
        axes = _directions(np.add.reduceat(vectors, cells, axis=0))
        along = np.einsum("ij,ij->i", vectors, np.repeat(axes, sizes, axis=0))
        rest = np.maximum.reduceat(np.sqrt(np.maximum(lengths * lengths - along * along, 0)), cells)
        most, least = np.maximum.reduceat(along, cells), np.minimum.reduceat(along, cells)
        found, waiting = [], 0
        for a in range(0, len(active), TILE):
            tile = active[a : a + TILE]
            x = self.vectors[tile]
            mine = x @ axes.T
            bound = np.sqrt(np.maximum((self.lengths[tile] ** 2)[:, None] - mine * mine, 0)) * rest
            bound += np.maximum(mine * most, mine * least)
            bound += slack[tile, None]
            needed = bound >= self.least[tile, None]
            for cell in np.flatnonzero(needed.any(axis=0)):
                pick = np.flatnonzero(needed[:, cell])
                first = starts[cell]
                products = x[pick] @ vectors[first : starts[cell + 1]].T
                hits = np.flatnonzero(products >= self.least[tile[pick], None])
                if len(hits):
                    row, column = np.divmod(hits, products.shape[1])
                    found.append((tile[pick[row]], products.ravel()[hits], ids[first + column]))
                    waiting += len(hits)
            if waiting > WAITING:
                self._merge(found)
                found, waiting = [], 0
        if found:
            self._merge(found)

    def _begin(self, vectors, lengths) -> None:
        """What the n-th best product is at least, by the longest vectors."""
        import numpy as np

        self.begun = True
        some = vectors[np.argsort(-lengths)[: max(1024, self.n)]]
        if len(some) < self.n:
            return
        for a in range(0, len(self.ids), 1024):
            products = self.vectors[a : a + 1024] @ some.T
            self.least[a : a + 1024] = np.partition(products, -self.n, axis=1)[:, -self.n]
        self.least -= np.float32(SLACK) * self.lengths * lengths.max()

    def _merge(self, found: list[tuple]) -> None:
        import numpy as np

        rows, products, others = (np.concatenate(x) for x in zip(*found, strict=True))
        touched, place = np.unique(rows, return_inverse=True)
        place = np.concatenate([np.repeat(np.arange(len(touched)), self.n), place])
        products = np.concatenate([self.products[touched].ravel(), products])
        others = np.concatenate([self.others[touched].ravel(), others])
        order = np.lexsort((-others, -products, place))
        first = np.searchsorted(place[order], np.arange(len(touched)))
        pick = order[first[:, None] + np.arange(self.n)]
        self.products[touched], self.others[touched] = products[pick], others[pick]
        self.least[touched] = np.maximum(self.least[touched], products[pick[:, -1]])

    def lists(self, other: str, size: int = 10_000) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.ids), size):
            products, others = self.products[a : a + size], self.others[a : a + size]
            there = others >= 0
            entries = pa.StructArray.from_arrays([pa.array(others[there], pa.int32()), pa.array(products[there], pa.float32())], [other, "rating"])
            ends = [0, *there.sum(axis=1).cumsum().tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[a : a + size]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)], ["id", "recommendations"])
