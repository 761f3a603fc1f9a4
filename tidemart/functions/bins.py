"""Binning rules as column expressions (they stay inside whole-stage codegen).

* ``fixed_bins``: right-closed intervals (a, b]; values outside every interval
  get NULL (pandas ``cut`` semantics, unlike ``Bucketizer`` which is left-closed).
* ``edge_bins``: quantile bins from edges e0 < e1 < ... < ek, right-closed with
  the lowest edge included (pandas ``qcut``/``cut(include_lowest=True)``);
  duplicate edges raise at run time, as pandas does.
* ``rank_quintile``: the bin of a unique rank r in 1..n split into k equal
  ranges; integer arithmetic, so no floating edge can misplace a rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_bins(x: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding x, else NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def edges_increasing(edges: Sequence[Column]) -> Column:
    ok = F.lit(True)
    for a, b in zip(edges[:-1], edges[1:]):
        ok = ok & (a < b)
    return ok


def edge_bins(x: Column, edges: Sequence[Column], labels: Sequence | None = None,
              include_lowest: bool = True) -> Column:
    """Index (1-based) or label of the bin of x for edges e0..ek (right-closed).

    Raises (``raise_error``) when the edges are not strictly increasing, the
    way pandas rejects duplicate bin edges.
    """
    k = len(edges) - 1
    labels = list(labels) if labels is not None else list(range(1, k + 1))
    lowest = (x >= edges[0]) if include_lowest else (x > edges[0])
    expr = None
    for i in range(k):
        lo_ok = lowest if i == 0 else (x > edges[i])
        cond = lo_ok & (x <= edges[i + 1])
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return F.when(~edges_increasing(edges),
                  F.raise_error(F.lit("Bin edges must be unique"))).otherwise(expr)


def rank_quintile(rank: Column, n: Column, k: int = 5) -> Column:
    """Bin of rank r among n unique ranks: max(1, ceil(k (r-1) / (n-1)))."""
    num = F.lit(k) * (rank - 1) + n - 2
    # integer ceil via floor of an exact quotient (num, n < 2**53 / k)
    score = F.greatest(F.lit(1), F.floor(num / (n - 1)))
    return F.when(n <= 1, F.raise_error(F.lit("Bin edges must be unique"))) \
            .otherwise(score.cast("int"))
