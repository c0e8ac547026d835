"""Starting, resuming and finishing streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def resume_from_checkpoint(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
) -> StreamingQuery:
    """Start a stream, or go on where its checkpoint stopped.

    ``checkpoint`` is a folder that all executors reach.  Without ``every``
    the query takes what there is and ends; with it, it runs at that interval.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(sink)
        .start()
    )


def run_to_end(
    df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update"
) -> None:
    """Take all available input and wait for the end; errors of the query are raised here."""
    resume_from_checkpoint(df, sink, checkpoint, mode).awaitTermination()


def batch_time_label(df: DataFrame, pattern: str = "yyyy/MM/dd HH:mm:ss") -> DataFrame:
    """Add the time of the batch as text; one value for all rows of a batch."""
    return df.withColumn("batch_time", F.date_format(F.current_timestamp(), pattern))
