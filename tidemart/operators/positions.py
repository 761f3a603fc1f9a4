"""Positions in a global order, JVM side only.

One range shuffle spreads the order over the partitions (all ordering columns
take part, so a hot leading value is split too). After the local sort,
``monotonically_increasing_id`` holds partition id and row index; writing the
result as Parquet under the shared work folder pins both, so a lost executor
re-reads it. The partition counts (one row per partition, so bounded by the
partition count) become offsets and are broadcast back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path

_MID = "_mid"


def write_and_reread(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared work folder and read it back:
    cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_positions(df: DataFrame, order: Sequence[Column | str], out: str = "position",
                   num_partitions: int | None = None) -> DataFrame:
    """``df`` (written once) plus ``out``: the 0-based place of each row in
    ``order``. Ties take consecutive places in an arbitrary but fixed order."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols))
    local = write_and_reread(
        ranged.sortWithinPartitions(*cols).withColumn(_MID, F.monotonically_increasing_id()),
        "positions")
    pid = F.shiftright(F.col(_MID), 33)
    counts = local.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    index = F.col(_MID).bitwiseAND(F.lit((1 << 33) - 1))
    return (local.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + index).drop("_pid", "_off", _MID))
