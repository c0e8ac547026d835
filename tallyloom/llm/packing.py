"""Packing of token pieces into sequences by a grouping genetic algorithm on islands.

The unit of the algorithm is a whole sequence with its pieces.  A crossover injects well-filled sequences of one
parent into the other, drops the sequences that hold an injected piece a second time, and puts the displaced pieces
by best fit, longest first, into what is free.  Spark deals the pieces to shards of a bounded number, each shard is
evolved on several islands (one row, one task each), and after every epoch the elite of an island migrates to its
neighbour.  The least filled sequences of all shards are then dissolved and packed once more, in fewer shards, until
one shard is left, so the shards' last, half-empty sequences do not add up.
"""

from __future__ import annotations

import functools
import itertools
import math
import random
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import sliced
from tallyloom.llm.bpe import Encoder, chunks, vocabulary_path
from tallyloom.llm.workers import kept_by, task_of
from tallyloom.shared_folder import staged

CAPACITY = 2048
#: New words that the library encodes at a time.
WORDS_AT_ONCE = 5000
SHARD_PIECES = 20_000
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4
#: Part of a shard's sequences that is packed once more with those of the other shards.
DISSOLVED = 0.05


class LibraryEncoder(Encoder):
    """Words are split as the encoder does; their ids come from the ``tokenizers`` library and are kept as bytes.

    A word met again costs a look-up: its ids are kept as the four bytes each that a checksum reads, once for all
    tasks of a worker.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__(path)
        self.library = Tokenizer.from_file(path)
        self.ending = np.zeros(max(self.strings) + 1, bool)
        self.ending[list(self.ends)] = True
        # The library merges and decodes; what that takes here is not held twice.
        self.strings, self.ranks, self.pairs = {}, {}, {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _token(self, word: str) -> bytes:
        return np.array([self.added[word]], "<u4").tobytes()

    def _merged(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a in range(0, len(words), WORDS_AT_ONCE):
            some = words[a : a + WORDS_AT_ONCE]
            ids = self._ids(" ".join(some))
            cuts = [0, *(4 * np.flatnonzero(self.ending[ids]) + 4).tolist()]
            if len(cuts) - 1 != len(some) or cuts[-1] != 4 * len(ids):  # a word that does not stand for itself among others
                out += [self._ids(w).tobytes() for w in some]
            else:
                data = ids.tobytes()
                out += [data[a:b] for a, b in itertools.pairwise(cuts)]
        return out

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian and of four bytes."""
        words = [self.split(t) for t in texts]
        self.learn(set().union(*words))
        kept = self.kept
        return [b"".join(map(kept.__getitem__, ws)) for ws in words]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        raise NotImplementedError("the ids of this encoder are decoded by bpe.Encoder")


@functools.lru_cache(maxsize=2)
def library_encoder(path: str | None) -> LibraryEncoder:
    return LibraryEncoder(path or vocabulary_path())


kept_by("packing", library_encoder.cache_clear)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False, path: str | None = None) -> DataFrame:
    """The pieces of every document: its token ids and ``end_id``, cut only if longer than ``capacity``.

    Columns doc_id, piece, start, length, ids_crc32 and, if asked for, ids.  A null or empty text is one piece
    that holds ``end_id`` alone.  Rows are taken as they come: a repeated row gives its pieces twice.
    """

    @task_of("packing")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in sliced(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                row, piece, start, length, crc, parts = [], [], [], [], [], []
                for i, ids in enumerate(coder.packed(texts[a:b]), a):
                    data = ids + end
                    for k, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            parts.append(np.frombuffer(part, "<i4"))
                columns = [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class _Shelf:
    """Sequences by the room they have left; the best fit is found in a bit mask of the rooms that occur."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, sequence: int, room: int) -> None:
        if not self.rooms[room]:
            self.mask |= 1 << room
        self.rooms[room].append(sequence)

    def take(self, size: int) -> tuple[int, int]:
        """A sequence with the least room that is enough, and its room; (-1, capacity) if there is none."""
        fits = self.mask >> size
        if not fits:
            return -1, self.capacity
        room = size + (fits & -fits).bit_length() - 1
        sequence = self.rooms[room].pop()
        if not self.rooms[room]:
            self.mask &= ~(1 << room)
        return sequence, room


class Packing:
    """Groups of pieces, their total lengths, and the fitness (fewer sequences, then fuller ones)."""

    def __init__(self, groups: list[list[int]], sizes: list[int], capacity: int) -> None:
        self.groups = groups
        self.fills = [sum(sizes[s] for s in g) for g in groups]
        self.fitness = (-len(groups), sum((f / capacity) ** 2 for f in self.fills))

    @staticmethod
    def fit(kept: list[list[int]], fills: list[int], loose: list[int], sizes: list[int], capacity: int) -> Packing:
        """``kept`` groups, with the loose pieces put by best fit in the order given."""
        groups, shelf = [list(g) for g in kept], _Shelf(capacity)
        for i, fill in enumerate(fills):
            if fill < capacity:
                shelf.add(i, capacity - fill)
        for slot in loose:
            at, room = shelf.take(sizes[slot])
            if at < 0:
                at = len(groups)
                groups.append([])
            groups[at].append(slot)
            if room > sizes[slot]:
                shelf.add(at, room - sizes[slot])
        return Packing(groups, sizes, capacity)


def crossover(mother: Packing, father: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """The mother with some well-filled sequences of the father."""
    order = sorted(range(len(father.groups)), key=lambda i: (-father.fills[i], rng.random()))
    pool = order[: max(1, len(order) // 2)]
    injected = rng.sample(pool, max(1, len(pool) // 4))
    inside = {s for i in injected for s in father.groups[i]}
    kept, fills, loose = [father.groups[i] for i in injected], [father.fills[i] for i in injected], []
    for group, fill in zip(mother.groups, mother.fills, strict=True):
        if inside.isdisjoint(group):
            kept.append(group)
            fills.append(fill)
        else:
            loose += [s for s in group if s not in inside]
    loose.sort(key=lambda s: -sizes[s])
    return Packing.fit(kept, fills, loose, sizes, capacity)


def evolve(sizes: list[int], start: list[list[list[int]]], capacity: int, rng: random.Random) -> Packing:
    """The best packing after some generations; stops at a packing that no other can beat."""
    least = -(-sum(sizes) // capacity)
    people = [Packing(g, sizes, capacity) for g in start]
    slots = sorted(range(len(sizes)), key=lambda s: -sizes[s])
    while len(people) < POPULATION:
        spread = 0 if not people else 0.3
        slots.sort(key=lambda s: -sizes[s] * (1 + spread * rng.random()))
        people.append(Packing.fit([], [], slots, sizes, capacity))
        if len(people[-1].groups) <= least:
            return people[-1]
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: p.fitness, reverse=True)
        if len(people[0].groups) <= least:
            break
        mother, father = people[0], rng.choice(people[1:])
        people[-1] = crossover(mother, father, sizes, capacity, rng)
        people.append(crossover(father, mother, sizes, capacity, rng))
        people = sorted(people, key=lambda p: p.fitness, reverse=True)[:POPULATION]
    return max(people, key=lambda p: p.fitness)


def _groups(assigned: list[int]) -> list[list[int]]:
    groups: dict[int, list[int]] = {}
    for slot, at in enumerate(assigned):
        groups.setdefault(at, []).append(slot)
    return list(groups.values())


def _island(capacity: int, epoch: int):
    @task_of("packing")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, island, sizes, elites in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rng = random.Random(f"{shard}/{island}/{epoch}")
                best = evolve(sizes, [_groups(e) for e in elites or []], capacity, rng)
                assigned, offsets = [0] * len(sizes), [0] * len(sizes)
                for i, group in enumerate(sorted(best.groups, key=lambda g: -sum(sizes[s] for s in g))):
                    at = 0
                    for slot in group:
                        assigned[slot], offsets[slot] = i, at
                        at += sizes[slot]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()), pa.array([island], pa.int32()), pa.array([len(best.groups)], pa.int32()),
                        pa.array([best.fitness[1]]), *(pa.array([x], pa.list_(pa.int32())) for x in (assigned, offsets)),
                    ],
                    names=["shard", "island", "sequences", "fitness", "assigned", "offsets"],
                )

    return run


ISLAND = "shard int, island int, sequences int, fitness double, assigned array<int>, offsets array<int>"


def _packed_shards(pieces: DataFrame, shards: int, capacity: int) -> DataFrame:
    """One row per piece of a bounded level: its shard, its sequence in the shard, offset, and number of sequences."""
    columns = [c for c in pieces.columns if c != "length"]
    crew = staged(
        pieces.withColumn("shard", F.pmod(F.xxhash64("piece_row"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .agg(F.sort_array(F.collect_list(F.struct("length", *columns)), asc=False).alias("pieces")),
        "shards",
    )
    lengths = crew.select("shard", F.transform("pieces", lambda p: p["length"].cast("int")).alias("sizes"))
    places = lengths.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    elites = None
    for epoch in range(EPOCHS):
        if elites is None:
            ready = places.select("shard", "island", "sizes", F.lit(None).cast("array<array<int>>").alias("elites"))
        else:
            stay = elites.select("shard", "island", "assigned")
            move = elites.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), "assigned")
            both = stay.unionByName(move).groupBy("shard", "island").agg(F.collect_list("assigned").alias("elites"))
            ready = places.join(both, ["shard", "island"]).select("shard", "island", "sizes", "elites")
        dealt = ready.repartition(min(shards * ISLANDS, 2000), "shard", "island")
        elites = staged(dealt.mapInArrow(_island(capacity, epoch), ISLAND), "islands")
    rank = F.struct(F.col("sequences"), -F.col("fitness"), F.col("island"))
    best = elites.groupBy("shard").agg(F.min_by(F.struct("assigned", "offsets", "sequences"), rank).alias("best"))
    return (
        crew.join(best, "shard")
        .select("shard", "best.sequences", F.explode(F.arrays_zip("pieces", F.col("best.assigned").alias("seq"), F.col("best.offsets").alias("offset"))).alias("p"))
        .select("shard", "sequences", "p.pieces.*", F.col("p.seq").alias("seq"), F.col("p.offset").cast("long").alias("offset"))
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with ``length``) with ``sequence_id`` and the ``offset`` in that sequence.

    Every row is placed once; offsets of a sequence have no gaps.  A null length counts as 0, a piece longer than
    ``capacity`` is an error, and an empty table gives an empty table.  Sequence numbers are distinct and otherwise
    arbitrary.
    """
    names = pieces.columns
    inner = pieces.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"))
    source = staged(inner.withColumn("piece_row", F.monotonically_increasing_id()), "pieces")
    longest, open_pieces = source.agg(F.max("length"), F.count(F.when(F.col("length") < capacity, 1))).first()
    if (longest or 0) > capacity:
        raise ValueError(f"a piece of {longest} is longer than {capacity}")
    done = [source.where(F.col("length") == capacity).select(*source.columns, (-1 - F.col("piece_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    level, rest = 0, source.where(F.col("length") < capacity)
    while open_pieces:
        shards = math.ceil(open_pieces / SHARD_PIECES)
        packed = staged(_packed_shards(rest, shards, capacity), "packed")
        last = F.col("seq") >= F.col("sequences") - F.ceil(F.col("sequences") * DISSOLVED) if shards > 1 else F.lit(False)
        number = F.lit(level << 56) + F.shiftleft(F.col("shard").cast("long"), 24) + F.col("seq")
        done.append(packed.where(~last).select(*source.columns, number.alias("sequence_id"), "offset"))
        rest = packed.where(last).select(*source.columns)
        open_pieces = rest.count() if shards > 1 else 0
        level += 1
    placed = done[0]
    for part in done[1:]:
        placed = placed.unionByName(part)
    return placed.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, of pieces with ``ids``: (sequence_id, ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
