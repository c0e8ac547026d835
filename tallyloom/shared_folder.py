"""Where intermediate tables and checkpoints go.

A cluster names one folder that every executor can reach in
``spark.checkpoint.dir``.  Everything this package writes for itself goes
below that folder, so that a lost executor never takes data with it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path, used by nobody else, below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for paths in _RECORDS.get():
        paths.append(path)
    return path


_RECORDS: ContextVar[tuple[list[str], ...]] = ContextVar("records", default=())


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that are made meanwhile, so that they can be discarded once nothing reads them any more."""
    paths: list[str] = []
    before = _RECORDS.set((*_RECORDS.get(), paths))
    try:
        yield paths
    finally:
        _RECORDS.reset(before)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete what lies at ``paths``."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the real
    size of a derived side, so that it can decide on broadcasting by a size
    that was measured and not guessed.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
