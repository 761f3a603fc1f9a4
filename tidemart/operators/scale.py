"""Ordered computations that stay distributed when one group or value is huge.

A window without ``partitionBy`` (global rank, running totals, exact
quantiles) moves every row into one task, and a window partitioned by a key
moves a hot key's rows into one task. This module does the same work in the
JVM: rows are spread by range over the full ordering (group columns first, so
a hot group is split), written once with their partition id and row index (see
``positions``), and a per-partition summary turns local positions and sums into
global ones. Payload columns never leave the JVM, so no value is changed.

Quantiles order nothing at all: ``selection`` finds the values at their ranks by
counting.

The plain-window form of each operator is the test oracle (tests/test_scale.py).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import selection
from .positions import write_and_reread

_MID, _PID, _RN = "_mid", "_pid", "_rn0"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _join_groups(left: DataFrame, right: DataFrame, cols: Sequence[str],
                 also: Column | None = None) -> DataFrame:
    """Inner join on ``cols`` where NULL equals NULL; keeps the left's columns."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in cols})
    on = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in cols] + ([] if also is None else [also])
    return left.join(renamed, reduce(lambda a, b: a & b, on)).drop(*[f"_right_{c}" for c in cols])


def row_numbers(df: DataFrame, order: Sequence, *, group_cols: Sequence[str] = (),
                weight_cols: Sequence[str] = (), out: str = "rn",
                num_partitions: int | None = None) -> DataFrame:
    """Row number (1-based) in ``order``, within ``group_cols`` when given, and
    inclusive running sums of ``weight_cols`` as ``cum_<w>``.

    ``order`` must make the order total (end with a unique key), as with
    ``row_number``. A NULL group is a group; NULL weights count as 0.
    """
    group_cols, weight_cols = list(group_cols), list(weight_cols)
    keys = [F.col(g) for g in group_cols] + [_col(c) for c in order]
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    local = write_and_reread(
        ranged.sortWithinPartitions(*keys).withColumn(_MID, F.monotonically_increasing_id()), "ordered")
    pid = F.shiftright(F.col(_MID), 33)
    # one row per partition: this window has as many rows as there are partitions
    parts = local.groupBy(pid.alias(_PID)).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(w).alias("_s_" + w) for w in weight_cols])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(_PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                           *[F.coalesce(F.sum("_s_" + w).over(before), F.lit(0)).alias("_off_" + w)
                             for w in weight_cols])
    res = local.withColumn(_PID, pid)
    inside = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    for w in weight_cols:  # a partition is a bounded slice of the order
        res = res.withColumn("cum_" + w, F.sum(F.coalesce(F.col(w), F.lit(0))).over(inside))
    res = res.join(F.broadcast(offsets), _PID)
    index = F.col(_MID).bitwiseAND(F.lit((1 << 33) - 1))
    res = res.withColumn(out, F.col("_off") + index + 1)
    for w in weight_cols:
        res = res.withColumn("cum_" + w, F.col("cum_" + w) + F.col("_off_" + w))
    res = res.drop(_MID, _PID, "_off", *["_off_" + w for w in weight_cols])
    if not group_cols:
        return res
    base = res.groupBy(*group_cols).agg(
        F.min(out).alias("_first"),
        *[F.min_by(F.col("cum_" + w) - F.coalesce(F.col(w), F.lit(0)), out).alias("_base_" + w)
          for w in weight_cols])
    joined = _join_groups(res, base, group_cols)
    return joined.withColumns({
        out: F.col(out) - F.col("_first") + 1,
        **{"cum_" + w: F.col("cum_" + w) - F.col("_base_" + w) for w in weight_cols},
    }).drop("_first", *["_base_" + w for w in weight_cols])


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], *,
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default, NULLs skipped).

    Returns one row per group and probability: ``group_cols..., p, q``.
    position h = (n-1)p; q = x[floor h] + (x[ceil h] - x[floor h]) * (h - floor h).
    The values at the two ranks are selected (see ``selection``): ``df`` is
    scanned for the counts and up to three times more, nothing is ordered. The
    passes run here; give a frame that is cheap to scan.
    """
    group_cols = list(group_cols)
    v = F.col(value).cast("double")
    vals = df.select(*group_cols, v.alias("_value")).filter(F.col("_value").isNotNull())
    vals = vals.withColumn("_image", selection.double_image(F.col("_value")))
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    h = (F.col("_n") - 1) * F.col("p")
    ranks = F.array(F.struct(F.lit(0).alias("_side"), (F.floor(h).cast("long") + 1).alias("_rank")),
                    F.struct(F.lit(1).alias("_side"), (F.ceil(h).cast("long") + 1).alias("_rank")))
    need = (vals.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0")
            .select(*group_cols, "_n", F.explode(probs_arr).alias("p"))
            .select(*group_cols, "p", (h - F.floor(h)).alias("_frac"), F.explode(ranks).alias("_need"))
            .select(*group_cols, "p", "_frac", "_need.*"))
    got = selection.at_ranks(vals, need, group_cols)
    res = got.groupBy(*group_cols, "p").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_value"))).alias("_vlo"),
        F.max(F.when(F.col("_side") == 1, F.col("_value"))).alias("_vhi"),
        F.max("_frac").alias("_frac"))
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return res.select(*group_cols, "p", q.alias("q"))


def quantile_edges(edges: DataFrame, probs: Sequence[float]) -> list[Column]:
    """The quantiles of a group-less ``exact_quantiles`` result as literals: one
    small job fetches ``len(probs)`` rows, the plan that uses them stays flat."""
    got = {r["p"]: r["q"] for r in edges.collect()}
    return [F.lit(got.get(float(p))).cast("double") for p in probs]


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], *,
                     group_cols: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Quantiles from Spark's ``percentile_approx`` (a mergeable sketch per
    group, relative rank error about 1/accuracy): one partial aggregation, no
    ordered pass. Same output layout as ``exact_quantiles``; use it by option
    when an exact rank is not required."""
    group_cols = list(group_cols)
    probs = [float(p) for p in probs]
    v = F.col(value).cast("double")
    agg = df.groupBy(*group_cols).agg(
        F.percentile_approx(v, F.array(*[F.lit(p) for p in probs]), accuracy).alias("_qs"))
    return agg.select(*group_cols, F.posexplode("_qs").alias("_i", "q")).select(
        *group_cols, F.array(*[F.lit(p) for p in probs])[F.col("_i")].alias("p"), "q")
