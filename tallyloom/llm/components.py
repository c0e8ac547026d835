"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.shared_folder import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): the smallest node that it is connected with.

    Smallest labels travel over links and then along labels, so chains shorten by half a round.  Every round is a
    table in the shared folder; nothing but the number of changed rows comes to the driver.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    now = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).select(F.col("a").alias("node"), "root"), "labels")
    while True:
        heard = both.join(now.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("heard"))
        lower = now.join(heard.select(F.col("a").alias("node"), "heard"), "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("root"))
        ahead = now.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = staged(lower.join(ahead, "root", "left").select("node", "old", F.least("root", F.coalesce("next", "root")).alias("root")), "labels")
        changed = after.where("old <> root").count()
        now = after.select("node", "root")
        if not changed:
            return now
