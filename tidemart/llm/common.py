"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import write_and_reread  # noqa: F401  (re-exported)

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash128(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes (NULL counts as absent)."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(7), *cols)]


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Identity of a document row, ``k1`` and ``k2``: a 128-bit hash of id and
    text that is never NULL. Repeated rows (same id and text) share it, rows
    that share only the id do not."""
    h1, h2 = hash128(doc_id, F.coalesce(text, F.lit("")))
    return [h1.alias("k1"), h2.alias("k2")]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def release_memory() -> None:
    """Give freed memory back to the system: a reused Python worker keeps what
    a task needed at its peak otherwise."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
