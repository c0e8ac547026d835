"""From raw documents to packed training sequences.

A stage takes (spark, docs, sf_dir) and returns the rows that its decisions leave; all but the last return the
columns of ``documents``.  Every stage works on all that the one before kept, as read back from Parquet.  What a stage
staged for itself is deleted when the next one begins, unless that reads it still.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import cuckoo, ordered_minhash, packing, suffixes, toxicity
from tallyloom.llm.registry import table
from tallyloom.shared_folder import discard, recorded, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Rows that go to a Python worker at a time.  Documents are long, and each batch is held on both sides.
BATCH_ROWS = "1000"
#: What the last stage of an application staged for itself.
_LEFT: dict[str, list[str]] = {}


def _tidy(stage: Stage) -> Stage:
    """The stage, after what the one before left has been deleted: its output was written, and is what ``docs`` reads."""

    @functools.wraps(stage)
    def run_tidy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        left = _LEFT.pop(application, [])
        read = docs.inputFiles() if left else []
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        discard(spark, [path for path in left if not any(path.rsplit("/", 1)[1] in file for file in read)])
        with recorded() as paths:
            out = stage(spark, docs, sf_dir)
        _LEFT[application] = paths
        return out

    return run_tidy


@_tidy
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that the lexicon, learned from the labels of this input, rejects."""
    lexicon = toxicity.learn(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, lexicon)


@_tidy
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of all documents that are equal but for white space: the longest, then the smallest doc_id."""
    return cuckoo.drop_exact_duplicates(docs)


@_tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates: that with the smallest doc_id."""
    return ordered_minhash.drop_near_duplicates(docs)


@_tidy
def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 bytes or more that a document with a smaller doc_id holds too."""
    return suffixes.cut_repeats(docs)


@_tidy
def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_dedup),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_removal),
    ("best-fit packing", sequence_packing),
]

#: Learned weights, sketches and packing have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{i}")
    return docs
