"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and joins over the links; links of one node are
never gathered. Each round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_and_reread

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (u, v): hang each node's larger (or not larger) neighbours on
    the smallest node of its neighbourhood."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return (near.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .filter("u != v"))
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return hung.unionByName(low.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``links``
    (u, v); works for any orderable node type."""
    links = write_and_reread(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u != v").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        links = write_and_reread(_star(_star(links, True).distinct(), False).distinct(), "links")
        # equal sets have equal counts and sums of hashes
        after = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before or after[0] == 0:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
