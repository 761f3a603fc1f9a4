"""The value of the row before, in groups of any size, with one shuffle.

The rows are dealt out by ranges of (group, order), so a group is split over as
many tasks as it has ranges; inside a range the row before is a local window.
Only the first row of a range looks further back: to the last row of the range
before it, of which there is one per range. The ranges are cut at evenly spaced
rows of a bounded sample (the rows with the smallest hashes), whatever the data
look like; no size decides between two ways.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled rows per range.
_SAMPLES = 32


def _splitters(df: DataFrame, keys: list[str], n: int) -> list:
    """At most ``n - 1`` rows of the keys, ascending, evenly spaced in the sample."""
    small = df.select(*keys).orderBy(F.xxhash64(*keys)).limit(n * _SAMPLES)
    rows = small.orderBy(*keys).collect()
    cut = [rows[len(rows) * i // n] for i in range(1, n)] if rows else []
    return list(dict.fromkeys(cut))


def range_number(df: DataFrame, keys: list[str], n: int) -> Column:
    """Of each row, how many splitters of ``df`` its keys are not below (0 to
    ``n`` - 1): found among the first splitters of runs, then within one run."""
    types = [df.schema[k].dataType for k in keys]
    cut = [F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(row, types, keys)])
           for row in _splitters(df, keys, n)]
    if not cut:
        return F.lit(0)
    key, run = F.struct(*keys), max(1, isqrt(len(cut)))
    runs = [cut[i:i + run] for i in range(0, len(cut), run)]

    def not_above(splitters: Column) -> Column:
        return F.size(F.filter(splitters, lambda s: s <= key))

    nth = not_above(F.array(*[r[0] for r in runs]))  # 0: below all
    inside = not_above(F.get(F.array(*[F.array(*r) for r in runs]), nth - 1))
    return F.when(nth == 0, 0).otherwise((nth - 1) * run + inside)


def lag_with_carry(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str,
                   partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out``: ``value`` of the row before in ``order`` within
    ``group``, NULL for a group's first row. Equal to ``lag`` over the window
    (a NULL group is a group); ``order`` must make the order total."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group, keys = list(group), [*group, *order]
    dealt = df.withColumn("_range", range_number(df, keys, n).cast("int"))
    own = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)])
    row = F.struct(own.alias("group"), F.col(value).alias("value"))
    inside = Window.partitionBy("_range").orderBy(*keys)
    local = (dealt.repartitionById(n, F.col("_range"))
             .withColumns({"_before": F.lag(row).over(inside), "_nth": F.row_number().over(inside)}))
    # one row per range
    last = dealt.groupBy("_range").agg(F.max_by(row, F.struct(*keys)).alias("_last"))
    carried = last.select(F.col("_range").alias("_to"), F.lag("_last").over(Window.orderBy("_range")).alias("_carry"))
    both = local.join(F.broadcast(carried), F.col("_range") == F.col("_to"), "left")
    before = F.when(F.col("_nth") == 1, F.col("_carry")).otherwise(F.col("_before"))
    return (both.withColumn("_before", before)
            .withColumn(out, F.when(F.col("_before.group").eqNullSafe(own), F.col("_before.value")))
            .drop("_range", "_before", "_nth", "_to", "_carry"))
