"""Topic messages to cells, and orders to their targets, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators.routing import ORDER_ROUTES, OTHER_ORDERS, route_by_type
from tallyloom.sinks.stores import BATCH


def topic_ingest_exactly(df: DataFrame, col: str = "value", topic: str = "topic") -> DataFrame:
    """Messages ``{r, f, q: [...], v: [...]}`` to cells; the topic names the target table."""
    message = F.from_json(col, schemas.TOPIC_MESSAGE)
    return (
        df.select(F.col(topic).alias("table"), message.alias("m"))
        .select("table", "m.r", "m.f", F.explode(F.arrays_zip("m.q", "m.v")).alias("c"))
        .select(
            "table",
            F.col("r").alias("rowkey"),
            F.col("f").alias("family"),
            F.col("c.q").alias("qualifier"),
            F.col("c.v").alias("value"),
        )
        .filter(F.col("rowkey").isNotNull() & F.col("value").isNotNull())
    )


def folder_sink(path: str, by: str) -> Callable[[DataFrame, int], None]:
    """One folder for each batch and, in it, for each value of ``by``.

    The checkpoint moves on after the batch is written; if it is written
    again, it takes the place of the first try.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(by).parquet(f"{path}/{BATCH}={batch_id}")

    return write


def stream_route_by_type(
    df: DataFrame,
    col: str = "order_type",
    routes: Mapping[str, str] = ORDER_ROUTES,
    default: str = OTHER_ORDERS,
) -> DataFrame:
    """Orders with their target; write them with ``folder_sink(path, "target")``."""
    return route_by_type(df, col, routes, default)
