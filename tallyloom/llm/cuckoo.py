"""Exact deduplication with a cuckoo-filter index over content digests.

A cuckoo filter keeps a 16-bit fingerprint of every live digest in one of two buckets of four slots.  A hit in
the filter proves nothing: the slot also names the stored key, the full SHA-256 digest of the normalised content,
and only an equal key makes two texts equal.  Digests can be taken out again, and a filter that overflows is
doubled and filled anew from the stored keys.

Spark deals the digests to shards by their own bits.  Before the shuffle every task folds the equal digests of a
batch into one row, so a text that a third of all rows repeat sends a row per batch and not a row per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.workers import task_of
from tallyloom.operators.membership import membership_anti_join, membership_bits
from tallyloom.shared_folder import staged

SPACES = " \t\n\x0b\x0c\r"
SLOTS = 4
MAX_KICKS = 200
#: Digests of one shard, on average; bounds the memory of a task.
SHARD_KEYS = 200_000

PARTIAL = "shard int, digest binary, n long, points long, doc_id long, row_id long"


class CuckooIndex:
    """Live digests with their counts and the best row of each.

    ``value`` of a digest is a list ``[count, order key, payload]``; the smallest order key wins.
    """

    def __init__(self, expected: int = 64) -> None:
        self._allocate(1 << max(2, math.ceil(math.log2(max(1, expected) / (SLOTS * 0.8)))))
        self.size = 0
        self.resizes = 0

    def _allocate(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (buckets * SLOTS)
        self.values: list[list | None] = [None] * (buckets * SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "big") or 1
        first = int.from_bytes(digest[10:18], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def _slot(self, digest: bytes) -> int:
        """The slot of a live digest, or -1: fingerprints first, then the stored key."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if self.prints[slot] == mark and self.keys[slot] == digest:
                    return slot
        return -1

    def get(self, digest: bytes) -> list | None:
        slot = self._slot(digest)
        return None if slot < 0 else self.values[slot]

    def insert(self, digest: bytes, count: int, order: tuple, payload: object) -> None:
        slot = self._slot(digest)
        if slot >= 0:
            value = self.values[slot]
            value[0] += count
            if order < value[1]:
                value[1], value[2] = order, payload
            return
        self._place(digest, [count, order, payload])
        self.size += 1

    def delete(self, digest: bytes, count: int = 1) -> bool:
        """Take ``count`` rows of a digest out; the digest leaves the filter with its last row."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        self.values[slot][0] -= count
        if self.values[slot][0] <= 0:
            self.prints[slot], self.keys[slot], self.values[slot] = 0, None, None
            self.size -= 1
        return True

    def _place(self, digest: bytes, value: list) -> None:
        for kick in range(MAX_KICKS):
            mark, first, second = self._places(digest)
            for bucket in (first, second):
                at = bucket * SLOTS
                for slot in range(at, at + SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.keys[slot], self.values[slot] = mark, digest, value
                        return
            slot = (second if kick & 1 else first) * SLOTS + (kick >> 1) % SLOTS
            evicted = self.keys[slot], self.values[slot]
            self.prints[slot], self.keys[slot], self.values[slot] = mark, digest, value
            digest, value = evicted
        live = list(self.items()) + [(digest, value)]
        self.resizes += 1
        self._allocate(self.buckets * 2)
        for key, kept in live:
            self._place(key, kept)

    def items(self) -> Iterator[tuple[bytes, list]]:
        return ((k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None)


def content_digests(docs: DataFrame, row_id: Column | None = None) -> DataFrame:
    """(row_id, doc_id, points, digest) of every row: the SHA-256 of its text without white space.

    A null text counts as empty.  ``row_id`` tells apart rows that are equal in every column.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        (F.monotonically_increasing_id() if row_id is None else row_id).alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("points"),
        F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"),
    )


def _order(points: int, doc_id: int | None, row_id: int) -> tuple:
    return -points, doc_id is None, doc_id or 0, row_id


def _folded(shards: int):
    @task_of("exact dedup")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[bytes, list] = {}
            columns = [batch.column(c).to_pylist() for c in ("digest", "points", "doc_id", "row_id")]
            for digest, points, doc_id, row_id in zip(*columns, strict=True):
                order = _order(points, doc_id, row_id)
                found = best.get(digest)
                if found is None:
                    best[digest] = [1, order, (points, doc_id, row_id)]
                else:
                    found[0] += 1
                    if order < found[1]:
                        found[1:] = order, (points, doc_id, row_id)
            kept = [v[2] for v in best.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int.from_bytes(d[:8], "big") % shards for d in best], pa.int32()),
                    pa.array(list(best), pa.binary()),
                    pa.array([v[0] for v in best.values()], pa.int64()),
                    *(pa.array([k[i] for k in kept], pa.int64()) for i in range(3)),
                ],
                names=["shard", "digest", "n", "points", "doc_id", "row_id"],
            )

    return run


def _fill(index: CuckooIndex, rows: pd.DataFrame) -> None:
    doc_ids = rows["doc_id"].astype(object).where(rows["doc_id"].notna(), None)
    for digest, n, points, doc_id, row_id in zip(rows["digest"], rows["n"], rows["points"], doc_ids, rows["row_id"], strict=True):
        doc_id = None if doc_id is None else int(doc_id)
        index.insert(bytes(digest), int(n), _order(int(points), doc_id, int(row_id)), (doc_id, int(row_id)))


def _dump(shard: int, index: CuckooIndex) -> pd.DataFrame:
    live = list(index.items())
    return pd.DataFrame(
        {
            "shard": shard,
            "digest": [k for k, _ in live],
            "group_size": pd.array([v[0] for _, v in live], "Int64"),
            "keep_points": pd.array([-v[1][0] for _, v in live], "Int64"),
            "keep_id": pd.array([v[2][0] for _, v in live], "Int64"),
            "keep_row": pd.array([v[2][1] for _, v in live], "Int64"),
        }
    )


INDEX = "shard int, digest binary, group_size long, keep_points long, keep_id long, keep_row long"


def shards_for(rows: int) -> int:
    return max(1, math.ceil(rows / SHARD_KEYS))


def build_index(digests: DataFrame, shards: int) -> DataFrame:
    """One row per live digest: how many rows have it, and which of them stays."""
    partial = digests.select("digest", "points", "doc_id", "row_id").mapInArrow(_folded(shards), PARTIAL)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        index = CuckooIndex(len(rows))
        _fill(index, rows)
        return _dump(int(rows["shard"].iloc[0]), index)

    return partial.groupBy("shard").applyInPandas(run, INDEX)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame, shards: int) -> DataFrame:
    """The index after rows came and went; ``added`` and ``removed`` are content digests.

    A digest whose last row is removed leaves the index.  Removing a digest that is not live changes nothing.
    A kept row that is itself removed keeps its name until the group is empty: the index has no list of members.
    """
    changes = added.select("digest", "points", "doc_id", "row_id").mapInArrow(_folded(shards), PARTIAL)
    gone = removed.select("digest", "points", "doc_id", "row_id").mapInArrow(_folded(shards), PARTIAL)
    old = index.select(
        "shard", "digest", F.col("group_size").alias("n"), F.col("keep_points").alias("points"),
        F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row_id"),
    )
    signed = old.unionByName(changes).unionByName(gone.withColumn("n", -F.col("n")))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        filled = CuckooIndex(len(rows))
        _fill(filled, rows[rows["n"] > 0])
        for digest, n in zip(rows.loc[rows["n"] < 0, "digest"], rows.loc[rows["n"] < 0, "n"], strict=True):
            filled.delete(bytes(digest), -int(n))
        return _dump(int(rows["shard"].iloc[0]), filled)

    return signed.groupBy("shard").applyInPandas(run, INDEX)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Columns: row_id, doc_id, keep_id, group_size, kept, digest.  Texts are equal when nothing but white space tells
    them apart; of equal texts the longest stays, then the smallest doc_id, then the first row.  Null texts are
    empty texts and equal to one another; a null doc_id comes after all others; an empty table gives an empty table.
    """
    digests = staged(content_digests(docs), "digests")
    groups = staged(build_index(digests, shards_for(digests.count())), "digest-index")
    repeated = groups.where("group_size > 1").select("digest", "group_size", "keep_id", "keep_row")
    joined = digests.join(repeated, "digest", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "row_id",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row_id"))).alias("kept"),
        "digest",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns they came with; repeated rows of a doc_id count as copies.

    The rows to drop are few; a filter of their numbers is sent to the documents, most of which then stay where they are.
    """
    source = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")
    digests = staged(content_digests(source, F.col("_row")), "digests")
    index = staged(build_index(digests, shards_for(source.count())), "digest-index")
    repeated = index.where("group_size > 1").select("digest", "keep_row")
    dropped = staged(digests.join(repeated, "digest").where("row_id <> keep_row").select(F.col("row_id").alias("_row")), "dropped")
    return membership_anti_join(source, dropped, "_row", staged(membership_bits(dropped, "_row"), "dropped-bits")).drop("_row")
