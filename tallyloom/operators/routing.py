"""Routing, splitting and reuse."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

# Order types and their targets.
ORDER_ROUTES = {"alipay": "htb_alipay", "weixin": "htb_weixin", "card": "htb_card"}
OTHER_ORDERS = "htb_other"


def route_by_type(
    df: DataFrame, col: str, routes: Mapping[str, str] = ORDER_ROUTES, default: str = OTHER_ORDERS
) -> DataFrame:
    """Add the target of every row; types without a route go to the default."""
    target = F.lit(default)
    for name, place in routes.items():
        target = F.when(F.col(col) == name, place).otherwise(target)
    return df.withColumn("target", target)


def write_routed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One pass, one folder for each target; the rows stay in the tasks they are in."""
    df.write.mode(mode).partitionBy("target").parquet(path)


def train_test_split(
    df: DataFrame, weights: tuple[float, float] = (0.8, 0.2), seed: int = 42, by: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of the columns ``by``, of all plain columns if none are named.

    A row falls on the same side however the files are cut, equal rows fall on one side, and nothing is sorted.
    """
    columns = by or [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    share = F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1_000_000))
    cut = round(1_000_000 * weights[0] / sum(weights))
    return df.filter(share < cut), df.filter(share >= cut)


@contextmanager
def cache_reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` for several results of one job, in memory and then on disk."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
