"""Date and time helpers, all JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days of ``later - earlier``: the day field of the interval.

    Truncates toward zero (36 h -> 1, -36 h -> -1), unlike ``datediff``,
    which counts calendar-date boundaries (36 h can give 2).
    """
    return F.extract(F.lit("DAY"), later - earlier)


def add_days(ts: Column, n: int) -> Column:
    return ts + F.make_dt_interval(days=F.lit(n))


def month_text(ts: Column) -> Column:
    """Calendar month of a timestamp as ``yyyy-MM`` text."""
    return F.date_format(ts, "yyyy-MM")


def interval_parts(later: Column, earlier: Column) -> dict[str, Column]:
    """Day, hour, minute and second fields of ``later - earlier``."""
    iv = later - earlier
    return {
        "days": F.extract(F.lit("DAY"), iv),
        "hours": F.extract(F.lit("HOUR"), iv),
        "minutes": F.extract(F.lit("MINUTE"), iv),
        "seconds": F.extract(F.lit("SECOND"), iv).cast("int"),
    }
