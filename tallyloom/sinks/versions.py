"""Stores that change by one switch: folders of rows, and small files that say which folders are the store.

A version file lists the runs of the store, oldest first.  A run is a folder with the rows of one batch, or of several
that were merged.  A change writes new folders first and then publishes a version under the next number; what fails
before that leaves the store as it was, and a reader that has read a version goes on with its folders whatever is
published meanwhile, until ``keep`` later versions are there.

Runs are merged in tiers: ``fan_in`` runs of a tier become one of the next, so a reader opens at most ``fan_in`` folders a
tier, and a row is written again once a tier and not once a batch.  A batch whose number is not above those of
the store was written before and is left out.  One stream writes a store at a time: a second stream, whose batches are
numbered from 0 again, needs a higher generation, and the store refuses it without one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

BATCH = "batch_id"
ATTEMPT = "attempt"
#: A batch's number is its id within its generation; all of a later generation come after those of an earlier one.
GENERATION = 1 << 40
#: The number of rows that a store begins with: below every batch of every generation.
FOLDED = -1
FAN_IN, KEEP = 8, 8

#: Rows of several runs, with the number of their run, to one row for each key; the flag says that nothing is older.
Merge = Callable[[DataFrame, bool], DataFrame]


class Run(NamedTuple):
    number: int
    tier: int
    path: str


class Version(NamedTuple):
    number: int
    runs: tuple[Run, ...] = ()
    #: The stream that writes each generation, where Spark says which it is.
    streams: dict[str, str] = {}
    #: Where each generation's starting rows are kept.
    seeds: dict[str, str] = {}

    @property
    def through(self) -> int | None:
        """The number of the newest batch."""
        return self.runs[-1].number if self.runs else None


NOTHING = Version(-1)


class Store:
    """The versions below one folder."""

    def __init__(self, spark: SparkSession, root: str, fan_in: int = FAN_IN, keep: int = KEEP) -> None:
        self.spark, self.root, self.fan_in, self.keep = spark, root.rstrip("/"), fan_in, keep

    # --- reading ----------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the versions that are there, oldest first."""
        folder = self._path("versions")
        fs = self._fs(folder)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def version(self, number: int | None = None) -> Version:
        """A version by number, or the newest; ``NOTHING`` before the first."""
        if number is None:
            known = self.versions()
            if not known:
                return NOTHING
            number = known[-1]
        path = self._path(f"versions/{number:020d}.json")
        stream = self._fs(path).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Version(number, tuple(Run(*r) for r in found["runs"]), found["streams"], found["seeds"])

    def rows(self, runs: tuple[Run, ...], schema: str | None = None) -> DataFrame:
        """The rows of some runs in one scan, with the number of their run as ``batch_id``."""
        reader = self.spark.read.option("basePath", f"{self.root}/rows")
        if schema:
            reader = reader.schema(f"{schema}, {BATCH} BIGINT, {ATTEMPT} STRING")
        else:
            reader = reader.option("mergeSchema", True)
        return reader.parquet(*[f"{self.root}/{r.path}" for r in runs]).drop(ATTEMPT)

    # --- writing ----------------------------------------------------------------------------

    def add(self, batch: DataFrame, batch_id: int, generation: int, merge: Merge, check: Callable[[DataFrame], None] | None = None) -> None:
        """Publish a batch, then merge what has become too many; a batch that is already in the store is left out."""
        now, number = self._admitted(batch_id, generation)
        if now is None:
            return
        run = self._write(batch, number, 0)
        if check:
            check(self.rows((run,)))
        self._publish(now, (*now.runs, run), generation)
        self.fold(merge)

    def replace(self, batch: DataFrame, batch_id: int, generation: int) -> None:
        """Publish a batch in place of all rows."""
        now, number = self._admitted(batch_id, generation)
        if now is None:
            return
        self._publish(now, (self._write(batch, number, 0),), generation)
        self._sweep()

    def fold(self, merge: Merge) -> None:
        """Merge every tier that has ``fan_in`` runs."""
        changed = False
        while True:
            now = self.version()
            full = [t for t in sorted({r.tier for r in now.runs}) if sum(r.tier == t for r in now.runs) >= self.fan_in]
            if not full:
                break
            group = tuple(r for r in now.runs if r.tier == full[0])
            at = now.runs.index(group[0])
            merged = self._write(merge(self.rows(group), at == 0), group[-1].number, full[0] + 1)
            self._publish(now, (*now.runs[:at], merged, *now.runs[at + len(group) :]))
            changed = True
        if changed:
            self._sweep()

    def seed(self, generation: int, current: Callable[[Version], DataFrame]) -> DataFrame | None:
        """The rows that were current when a generation began; kept for all of it.  None for the first of a store."""
        now = self.version()
        if str(generation) not in now.seeds:
            if now.through is None or now.through // GENERATION >= generation:
                return None
            path = f"seeds/{generation}-{uuid.uuid4().hex}"
            current(now).write.parquet(f"{self.root}/{path}")
            self._publish(now, now.runs, seeds={str(generation): path})
            now = self.version()
        return self.spark.read.parquet(f"{self.root}/{now.seeds[str(generation)]}")

    # --- parts ------------------------------------------------------------------------------

    def _admitted(self, batch_id: int, generation: int) -> tuple[Version | None, int]:
        now, number, stream = self.version(), generation * GENERATION + batch_id, self._stream()
        if now.through is not None and now.through // GENERATION > generation:
            raise ValueError(f"{self.root}: generation {generation} is over, {now.through // GENERATION} has begun")
        known = now.streams.get(str(generation))
        if stream and known and stream != known:
            raise ValueError(f"{self.root}: another stream writes generation {generation}; a new checkpoint needs a higher one")
        return (None if now.through is not None and number <= now.through else now), number

    def _stream(self) -> str | None:
        """The id that a streaming query keeps in its checkpoint; none outside of ``foreachBatch``."""
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")

    def _write(self, rows: DataFrame, number: int, tier: int) -> Run:
        path = f"rows/{BATCH}={number}/{ATTEMPT}={uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{path}")
        return Run(number, tier, path)

    def _publish(self, base: Version, runs: tuple[Run, ...], generation: int | None = None, seeds: dict[str, str] | None = None) -> None:
        """Make ``runs`` the store, unless somebody else has published since ``base`` was read."""
        streams, stream = dict(base.streams), self._stream()
        if generation is not None and stream:
            streams[str(generation)] = stream
        text = json.dumps({"runs": runs, "streams": streams, "seeds": base.seeds | (seeds or {})})
        draft, final = self._path(f"versions/.{uuid.uuid4().hex}"), self._path(f"versions/{base.number + 1:020d}.json")
        fs = self._fs(draft)
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"{self.root}: version {base.number + 1} was published by somebody else")

    def _sweep(self) -> None:
        """Forget all but the newest ``keep`` versions, and the folders that only the others name."""
        known = self.versions()
        old, held = known[: -self.keep], [self.version(n) for n in known[-self.keep :]]
        kept = {r.path for v in held for r in v.runs} | {p for v in held for p in v.seeds.values()}
        for number in old:
            gone = self.version(number)
            for path in {r.path for r in gone.runs} - kept:
                folder = self._path(path)
                self._fs(folder).delete(folder, True)
            name = self._path(f"versions/{number:020d}.json")
            self._fs(name).delete(name, False)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
