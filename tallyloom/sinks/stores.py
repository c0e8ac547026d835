"""Sinks for ``foreachBatch``: each returns a function of (batch, batch id).

Micro-batches may be run again after a failure.  A second run changes nothing: a batch goes to a place that its id
decides, replaces what it wrote before, or is left out because its store has it (``tallyloom.sinks.versions``).

``generation`` is 0 for the first stream that writes a store and has to be higher for each later one that starts with a
new checkpoint, whose batch ids start at 0 again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.membership import BLOCKS, membership_bits, merged_bits
from tallyloom.sinks.versions import BATCH, FAN_IN, FOLDED, GENERATION, NOTHING, Merge, Store, Version

#: A row of a batch that has true here takes its key out of the store.
GONE = "_gone"

BatchSink = Callable[[DataFrame, int], None]


def batch_path(path: str, batch_id: int, generation: int = 0) -> str:
    """The folder of a batch; batches of a later generation come after all of an earlier one."""
    return f"{path}/{BATCH}={generation * GENERATION + batch_id}"


def append_sink(path: str, generation: int = 0) -> BatchSink:
    """Keep every row; batch n is the folder ``batch_id=n``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch_id, generation))

    return write


def _latest(rows: DataFrame, whole: bool, keys: list[str]) -> DataFrame:
    """The newest row of every key.  Partial maxima go through the shuffle, not all versions."""
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    if not values:
        return rows.select(*keys).distinct()
    latest = F.max_by(F.struct(*values), F.col(BATCH)).alias("latest")
    kept = rows.groupBy(*keys).agg(latest).select(*keys, "latest.*")
    return kept.where(~F.coalesce(GONE, F.lit(False))) if whole and GONE in values else kept


def _members(rows: DataFrame, whole: bool, key: str) -> DataFrame:
    return rows.select(key).distinct()


def _sums(rows: DataFrame, whole: bool, keys: list[str], count: str, newest: str | None = None) -> DataFrame:
    latest = [F.max(newest).alias(newest)] if newest else []
    return rows.groupBy(*keys).agg(F.sum(count).alias(count), *latest)


def _all(rows: DataFrame, whole: bool) -> DataFrame:
    return rows.drop(BATCH)


def upsert_sink(path: str, keys: list[str], generation: int = 0, newest: str | None = None, fan_in: int = FAN_IN) -> BatchSink:
    """Insert or update by key.

    A batch writes only the rows it changed, never the whole store.  A key must be unique within a batch, as it is
    after a streaming aggregation on it; with ``newest`` the row that has most in that column is taken (of equal ones
    any), without it a repeated key is refused.  Rows with a true ``_gone`` delete their key.
    """

    def unique(rows: DataFrame) -> None:
        twice = rows.groupBy(*keys).count().where("count > 1").select(*keys).first()
        if twice:
            raise ValueError(f"a key is there twice in one batch: {twice.asDict()}")

    def write(batch: DataFrame, batch_id: int) -> None:
        missing = [k for k in keys if k not in batch.columns]
        if missing:
            raise ValueError(f"key columns not in the batch: {missing}")
        if newest:
            row = F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), F.col(newest)).alias("row")
            batch = batch.groupBy(*keys).agg(row).select(*keys, "row.*")
        store = Store(batch.sparkSession, path, fan_in)
        store.add(batch, batch_id, generation, functools.partial(_latest, keys=keys), None if newest else unique)

    return write


def _at(store: Store, version: int | None, schema: str | None) -> Version | None:
    """The version to read; none if nothing was written yet and the ``schema`` says what an empty table looks like."""
    found = store.version(version)
    if found is NOTHING or not found.runs:
        if schema is None:
            raise ValueError(f"nothing was written to {store.root} yet; a schema would make it an empty table")
        return None
    return found


def _read(spark: SparkSession, path: str, merge: Merge, schema: str | None, version: int | None) -> DataFrame:
    store = Store(spark, path)
    found = _at(store, version, schema)
    return spark.createDataFrame([], schema) if found is None else merge(store.rows(found.runs), True)


def _current(rows: DataFrame, whole: bool, keys: list[str]) -> DataFrame:
    return _latest(rows, True, keys).drop(GONE)


def read_upserted(spark: SparkSession, path: str, keys: list[str], schema: str | None = None, version: int | None = None) -> DataFrame:
    """The current row of every key, or that of an older ``version`` that is still kept.

    With a ``schema``, a store without a batch yet is an empty table.
    """
    return _read(spark, path, functools.partial(_current, keys=keys), schema, version)


def fold_upserts(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    """Write the current rows to a new store; the batches of any generation come after them."""
    if Store(spark, target).versions():
        raise ValueError(f"{target} is no new store")
    Store(spark, target).replace(read_upserted(spark, path, keys), FOLDED, 0)


def hash_sink(path: str, key: str, generation: int = 0, fan_in: int = FAN_IN) -> BatchSink:
    """Latest value of each key."""
    return upsert_sink(path, [key], generation, fan_in=fan_in)


def total_sink(path: str, keys: list[str], total: str, generation: int = 0, fan_in: int = FAN_IN) -> BatchSink:
    """Running totals by key, also of a stream that had to begin anew.

    The state of a stream with a new checkpoint starts at 0.  The totals of its generation are therefore added to those
    that the store had when the generation began; these are kept as they were, so a batch that is run again adds to
    the same.  Numbers are added as decimals with six places.
    """
    upsert = upsert_sink(path, keys, generation, fan_in=fan_in)

    def write(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path, fan_in)
        before = store.seed(generation, lambda v: _current(store.rows(v.runs), True, keys).select(*keys, total))
        if before is not None:
            names, kind = batch.columns, batch.schema[total].dataType
            before = before.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(total).alias("_before"))
            same = functools.reduce(lambda a, b: a & b, [batch[k].eqNullSafe(before[f"_{k}"]) for k in keys])
            exact = [F.coalesce(F.col(c).cast("decimal(38,6)"), F.lit(0)) for c in (total, "_before")]
            batch = batch.join(before, same, "left").withColumn(total, (exact[0] + exact[1]).cast(kind)).select(*names)
        upsert(batch, batch_id)

    return write


def set_sink(path: str, key: str, generation: int = 0, fan_in: int = FAN_IN) -> BatchSink:
    """Members of a set; a member never leaves."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path, fan_in)
        store.add(batch.select(key).distinct(), batch_id, generation, functools.partial(_members, key=key))

    return write


def read_set(
    spark: SparkSession, path: str, key: str, key_type: str = "BIGINT", version: int | None = None, repeats: bool = False
) -> DataFrame:
    """The members; none while nothing has been written.

    With ``repeats`` a member may be there several times, at most once a run: enough for an anti join, without a shuffle.
    """
    merge = (lambda rows, whole: rows.select(key)) if repeats else functools.partial(_members, key=key)
    return _read(spark, path, merge, f"{key} {key_type}", version)


def _any_bits(rows: DataFrame, whole: bool) -> DataFrame:
    return merged_bits(rows)


def bits_sink(path: str, key: str, generation: int = 0, blocks: int = BLOCKS, fan_in: int = FAN_IN) -> BatchSink:
    """The membership filter of a growing list.  Write a batch here before it goes to the list itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        Store(batch.sparkSession, path, fan_in).add(membership_bits(batch, key, blocks), batch_id, generation, _any_bits)

    return write


def read_bits(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The filter of all that was written; it has no blocks while nothing was."""
    return _read(spark, path, _any_bits, "block INT, bits BINARY", version)


def count_sink(
    path: str, keys: list[str], count: str = "click_count", generation: int = 0, newest: str | None = None, fan_in: int = FAN_IN
) -> BatchSink:
    """Counts of the rows of each batch by key; the totals are their sum, and runs are folded to sums.

    With ``newest``, a column of the batch, the largest value of each key is kept too.
    """
    latest = [F.max(newest).alias(newest)] if newest else []

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *latest)
        store = Store(batch.sparkSession, path, fan_in)
        store.add(counted, batch_id, generation, functools.partial(_sums, keys=keys, count=count, newest=newest))

    return write


def read_counts(
    spark: SparkSession,
    path: str,
    keys: list[str],
    count: str = "click_count",
    schema: str | None = None,
    newest: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """Totals by key.  With a ``schema``, a store without a batch yet is an empty table."""
    return _read(spark, path, functools.partial(_sums, keys=keys, count=count, newest=newest), schema, version)


def largest(spark: SparkSession, path: str, column: str):
    """The largest value that any stored row has in a column; none without rows."""
    store = Store(spark, path)
    now = store.version()
    return store.rows(now.runs).agg(F.max(column)).first()[0] if now.runs else None


def changed_rows(current: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """What an upsert has to write so that a store with the rows ``current`` holds exactly ``wanted``.

    New and changed rows, and a row marked ``_gone`` for each key that is not wanted any more; its other columns are
    null.  Both have the same columns, and a key is there once in each.
    """
    values = [c for c in wanted.columns if c not in keys]
    both = wanted.select(*keys, F.struct(*values).alias("new")).join(current.select(*keys, F.struct(*values).alias("old")), keys, "full")
    changed = both.where(~F.col("new").eqNullSafe(F.col("old")))
    return changed.select(*keys, "new.*", F.col("new").isNull().alias(GONE))


def replace_sink(path: str, generation: int = 0) -> BatchSink:
    """The target holds the latest batch only; readers see the old rows or the new ones, never parts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        Store(batch.sparkSession, path).replace(batch, batch_id, generation)

    return write


def read_replaced(spark: SparkSession, path: str, schema: str | None = None, version: int | None = None) -> DataFrame:
    """What the latest batch wrote."""
    return _read(spark, path, _all, schema, version)


def replace_partition_sink(path: str, by: str) -> BatchSink:
    """Replace exactly the values of ``by`` that the batch holds; others stay as they are."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(by)
            .parquet(path)
        )

    return write


def key_value(df: DataFrame, key: str, values: list[str], sep: str = ",") -> DataFrame:
    """Messages: the key as text, the values joined by ``sep``."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.concat_ws(sep, *[F.col(v).cast("string") for v in values]).alias("value"),
    )


def topic_sink(
    df: DataFrame, key: str, values: list[str], fmt: str, options: dict[str, str] | None = None
) -> None:
    """Send a batch of messages to a topic, or append them as files; sent again they are there twice (``topic_log_sink``)."""
    key_value(df, key, values).write.format(fmt).options(**(options or {})).mode("append").save()


def topic_log_sink(path: str, key: str, values: list[str], generation: int = 0, sep: str = ",", fan_in: int = FAN_IN) -> BatchSink:
    """Messages of each batch as files, with a log of the batches: one that is sent again is in the topic once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        Store(batch.sparkSession, path, fan_in).add(key_value(batch, key, values, sep), batch_id, generation, _all)

    return write


def read_topic(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The messages of all batches that were sent to the end."""
    return _read(spark, path, _all, "key STRING, value STRING", version)


def memory_console_sink(df: DataFrame, name: str | None = None, mode: str = "update"):
    """A started query that prints its batches, or keeps them in memory under a name.

    Memory rows live on the driver: for looking at small results only.
    """
    writer = df.writeStream.outputMode(mode)
    if name:
        return writer.format("memory").queryName(name).start()
    return writer.format("console").start()
