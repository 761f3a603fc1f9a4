"""The rows at given ranks, without ordering the rows.

Every value has a 64-bit image with the same order. One aggregate counts the
values per group and leading 22 bits of the image; the running counts say which
bucket holds each wanted rank. Only the buckets that hold one are looked at
again, by the next 21 bits and then the last 21: three passes at most, and none
after the first whose buckets hold a single value. What is shuffled are counts
(at most 4 million buckets a group), pre-aggregated where the rows are; the rows
themselves are never moved, ordered or copied. A group or a value may hold any
share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .positions import write_and_reread

#: Bits left below the bucket in each pass.
_SHIFTS = (42, 21, 0)
#: Chosen buckets are broadcast up to this many (about 40 bytes each).
_BROADCAST_ROWS = 100_000
_IMAGE, _VALUE, _RANK = "_image", "_value", "_rank"


def double_image(v: Column) -> Column:
    """A bigint with the order of the doubles (NaN last, -0 equal to 0)."""
    plain = F.when(v == 0, F.lit(0.0)).otherwise(v)
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), plain).cast("bigint")
    flip = F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1))
    return bits.bitwiseXOR(flip)


def hex_image(h: Column) -> Column:
    """A bigint with the order of the first 15 digits of a lower-case hex text."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r{c}"]) for c in cols])


def _renamed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_r{c}" for c in cols})


def _look(values: DataFrame, need: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """``need`` with its rank's bucket (``_cell``), the rank inside it and the
    smallest and largest value of the bucket."""
    cells = values.groupBy(*keys, F.shiftright(_IMAGE, shift).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_VALUE).alias("_low"), F.max(_VALUE).alias("_high"))
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = _renamed(cells.withColumn("_upto", F.sum("_n").over(upto)), keys)
    hit = (F.col(_RANK) > F.col("_upto") - F.col("_n")) & (F.col(_RANK) <= F.col("_upto"))
    return (need.join(cells, _same(need, cells, keys) & hit)
            .withColumn(_RANK, F.col(_RANK) - (F.col("_upto") - F.col("_n")))
            .drop("_upto", "_n", *[f"_r{c}" for c in keys]))


def at_ranks(values: DataFrame, need: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``values``: the groups, ``_image`` (bigint) and ``_value`` (in the order
    of the image). ``need``: the groups, further columns and ``_rank`` (from 1).
    Returns ``need`` with ``_value``, and ``_rank`` counted among the rows of
    that same value; ranks beyond a group's rows are left out."""
    groups = list(groups)
    if not groups:  # one group
        values, need, groups = values.withColumn("_all", F.lit(0)), need.withColumn("_all", F.lit(0)), ["_all"]
    kept = [c for c in need.columns if c not in ("_all", _RANK)]
    keys, found, rest = list(groups), [], values
    for i, shift in enumerate(_SHIFTS):
        # one row a wanted rank; written, as the next pass reads it twice
        need = write_and_reread(_look(rest, need, keys, shift), "ranks")
        settled = F.col("_low").eqNullSafe(F.col("_high"))
        done = settled if i + 1 < len(_SHIFTS) else F.lit(True)
        found.append(need.filter(done).select(*kept, F.col("_low").alias(_VALUE), _RANK))
        need = need.filter(~done).withColumnRenamed("_cell", f"_c{i}").drop("_low", "_high")
        if need.isEmpty():
            break
        keys.append(f"_c{i}")
        chosen = need.select(*keys).distinct()
        chosen = _renamed(F.broadcast(chosen) if chosen.count() <= _BROADCAST_ROWS else chosen, keys)
        cut = values.withColumns({f"_c{k}": F.shiftright(_IMAGE, s) for k, s in enumerate(_SHIFTS[:i + 1])})
        rest = cut.join(chosen, _same(cut, chosen, keys), "left_semi")
    return reduce(DataFrame.unionByName, found)
