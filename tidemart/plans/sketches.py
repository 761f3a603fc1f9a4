"""Distinct counts by mergeable sketches, on request.

A HyperLogLog sketch of each period is a column of a small stored table. Sketches
of months merge into those of quarters, years or any set of months without
reading an order again; exact distinct counts cannot be added up. ``precision``
bits give a relative standard error of about 1.04 / sqrt(2 ** precision), and a
sketch is at most 2 ** precision bytes, however many values it has seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import versions

PRECISION = 14


def error_bound(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """Relative error that ``deviations`` standard errors allow."""
    return deviations * 1.04 / 2 ** (precision / 2)


def distinct_sketches(df: DataFrame, by: Sequence[Column | str], what: Sequence[str],
                      precision: int = PRECISION) -> DataFrame:
    """One row per ``by`` with ``rows`` and a sketch ``<column>_sketch`` of each
    of ``what`` (NULL values are not counted). One partial aggregation."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(precision)).alias(f"{c}_sketch") for c in what])


def store(sketches: DataFrame, path: str) -> DataFrame:
    """Keep a sketch table as the next version under ``path``."""
    return versions.publish(sketches, path)


def merge(sketches: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Sketches of larger groups: the rows added up, the sketches united."""
    what = [c for c in sketches.columns if c.endswith("_sketch")]
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), *[F.hll_union_agg(c).alias(c) for c in what])


def estimates(sketches: DataFrame) -> DataFrame:
    """The sketches as ``approx_<column>`` counts."""
    return sketches.select(*[
        F.hll_sketch_estimate(c).alias(f"approx_{c.removesuffix('_sketch')}") if c.endswith("_sketch") else F.col(c)
        for c in sketches.columns])
