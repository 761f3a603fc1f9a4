"""Column types of text tables, found by one mergeable aggregate.

Each column keeps a few counts (missing values, what parses as what), which add
up over any split of the rows. The types are those that pandas' reader gives:
integers without missing values are 64-bit integers, with missing values they
are doubles; a column without any value is double; booleans need to be complete;
all else is text. Dates stay text unless asked for (``parse_dates``).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"
_BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")  # fixed values


class Profile(NamedTuple):
    """Of one column: rows, missing, and how many values parse as each type."""

    rows: int
    missing: int
    integers: int
    numbers: int
    booleans: int
    longest: int  # characters

    @property
    def type(self) -> str:
        there = self.rows - self.missing
        if there == self.integers == self.rows and there:
            return "bigint"
        if there == self.numbers:
            return "double"
        if there == self.booleans == self.rows:
            return "boolean"
        return "string"


def _counts(c: Column) -> Column:
    integer = c.rlike(_INTEGER) & F.trim(c).try_cast("bigint").isNotNull()
    return F.struct(
        F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).alias("missing"),
        F.count_if(integer).alias("integers"), F.count_if(c.rlike(_NUMBER)).alias("numbers"),
        F.count_if(c.isin(*_BOOLEANS)).alias("booleans"), F.coalesce(F.max(F.length(c)), F.lit(0)).alias("longest"))


def profiles(text: DataFrame) -> dict[str, Profile]:
    """One job, one pass, one row per task."""
    if not text.columns:
        return {}
    row = text.agg(*[_counts(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(text.columns)]).first()
    return {c: Profile(*row[f"c{i}"]) for i, c in enumerate(text.columns)}


def typed(text: DataFrame, found: dict[str, Profile], parse_dates: Sequence[str] = ()) -> DataFrame:
    """The columns cast to their types; ``parse_dates`` become timestamps."""
    def cast(c: str) -> Column:
        col = F.col(f"`{c}`")
        if c in parse_dates:
            return F.to_timestamp_ntz(col)
        kind = found[c].type
        return col if kind == "string" else F.trim(col).cast(kind)

    unknown = set(parse_dates) - set(text.columns)
    if unknown:
        raise ValueError(f"no such columns to parse as dates: {sorted(unknown)}")
    return text.select(*[cast(c).alias(c) for c in text.columns])
