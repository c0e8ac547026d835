"""A list of users that clicks are filtered by, and that clicks make longer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.joins import BROADCAST_ROWS, blacklist_broadcast_filter, whitelist_exclusion
from tallyloom.sinks.stores import bits_sink, read_bits, read_set, set_sink


def blacklist_sink(
    path: str,
    white: DataFrame,
    user: str = "user_id",
    threshold: int = 100,
    inclusive: bool = False,
    generation: int = 0,
) -> Callable[[DataFrame, int], None]:
    """For a stream of window counts: users above the threshold join the list for good.

    Each batch also goes to the list's membership filter, and there first: the filter never has less than the list.
    """
    add, mark = set_sink(path, user, generation), bits_sink(f"{path}-bits", user, generation)

    def write(counts: DataFrame, batch_id: int) -> None:
        cnt = F.col("cnt")
        hot = counts.filter(cnt >= threshold if inclusive else cnt > threshold).select(user)
        new = whitelist_exclusion(hot, white, user).distinct().persist()
        try:
            mark(new, batch_id)
            add(new, batch_id)
        finally:
            new.unpersist()

    return write


def filter_blacklisted_stream(
    df: DataFrame, black: DataFrame, key: str = "user_id", bits: DataFrame | None = None, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of users that are not listed; ``bits`` is the list's membership filter, for lists above ``max_rows``.

    On a stream, call it in ``foreachBatch`` with a freshly read list: a
    stream joined with a file table would keep the files it saw at the start.
    """
    return blacklist_broadcast_filter(df, black, key, max_rows, bits)


def filtered_batches(
    list_path: str, sink: Callable[[DataFrame, int], None], key: str = "user_id"
) -> Callable[[DataFrame, int], None]:
    """Read the list and its filter again for every batch and hand the rows that pass to ``sink``.

    Users that the running batch puts on the list are left out from the next one on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        black = read_set(spark, list_path, key, repeats=True)
        sink(filter_blacklisted_stream(batch, black, key, read_bits(spark, f"{list_path}-bits")), batch_id)

    return write
