"""CSV landing files and Parquet tables: scans, loads and materialisation.

Layout under the shared work folder (``session.work_path``):
    landing/<source>/<file name>.csv/   CSV files as they arrive (one folder each)
    warehouse/raw/<table>/<version>/    raw tables, all text, Parquet
    warehouse/marts/<model>/<version>/  materialised marts, Parquet
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.positions import write_and_reread
from ..schemas import FILE_TABLE_MAP, RAW_COLUMNS, raw_schema
from ..session import work_path
from . import inference, quoted_csv, versions

# Text that pandas reads as a missing value by default.
PANDAS_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]
# Tables whose free text may hold line breaks: their records are cut by
# ``quoted_csv``, the others' lines are records.
MULTILINE_TABLES = {"order_reviews"}
CHUNK_ROWS = 5_000_000  # rows per file; a parameter of ``chunked_write``


def source_tag(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]


def na_to_null(df: DataFrame, na_values=PANDAS_NA_VALUES) -> DataFrame:
    """Turn pandas' default missing-value markers into NULL, column by column."""
    marks = F.array(*[F.lit(v) for v in na_values])
    return df.select(*[F.when(F.array_contains(marks, F.col(f"`{c}`")), None)
                        .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


class HeaderMismatch(ValueError):
    pass


def read_csv_text(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a landing CSV with every column as text (no inference).

    Columns are matched by the header's names, in any order; a missing or
    unknown column is an error, and so is a file of the folder whose header
    differs from the first one's.
    """
    options = {"header": True, "escape": '"'}
    split = table in MULTILINE_TABLES
    text = quoted_csv.read_records(spark, path) if split else None
    found = text.columns if split else spark.read.options(**options).csv(path).columns
    wanted = RAW_COLUMNS[table]
    if found and sorted(found) != sorted(wanted):
        raise HeaderMismatch(
            f"{path}: missing columns {sorted(set(wanted) - set(found))}, "
            f"unknown columns {sorted(set(found) - set(wanted))}")
    if split:
        return na_to_null(text).select(*wanted) if found else spark.createDataFrame([], raw_schema(table))
    schema = StructType([StructField(c, StringType()) for c in found]) if found else raw_schema(table)
    rows = (spark.read.schema(schema).options(**options).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))
    return na_to_null(rows).select(*wanted)


def read_csv_inferred(spark: SparkSession, path: str, parse_dates: Sequence[str] = ()) -> DataFrame:
    """Read a CSV with the column types that pandas would give it: missing-value
    marks are NULL, line breaks may stand inside quotes. The files are parsed
    once; the types come from one aggregate over the parsed text."""
    text = write_and_reread(na_to_null(quoted_csv.read_records(spark, path)), "csv-text")
    return inference.typed(text, inference.profiles(text), parse_dates)


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .csv(path))


def export_landing(spark: SparkSession, raw: dict[str, DataFrame], dest: str,
                   file_map: dict[str, str] = FILE_TABLE_MAP) -> str:
    """Write each raw table to its landing CSV file name under ``dest``."""
    for fname, table in file_map.items():
        write_csv(raw[table], f"{dest}/{fname}")
    return dest


def landing_for(spark: SparkSession, sf_dir: str, raw: dict[str, DataFrame]) -> str:
    """Export one source to a landing folder of its own."""
    return export_landing(spark, raw, work_path(spark, "landing", f"{source_tag(sf_dir)}-{uuid.uuid4().hex[:8]}"))


def full_refresh_load(df: DataFrame, path: str) -> DataFrame:
    """Replace a table whole (idempotent); return its row count from a re-read."""
    return versions.publish(df, path).agg(F.count(F.lit(1)).alias("rows"))


def load_report_row(spark: SparkSession, table: str, fname: str, status: str,
                    path: str | None) -> DataFrame:
    if path is None:
        base = spark.range(1).select(F.lit(0).cast("long").alias("rows"))
    else:
        base = versions.read(spark, path).agg(F.count(F.lit(1)).alias("rows"))
    return base.select(F.lit(table).alias("table_name"), F.lit(fname).alias("file_name"),
                       F.lit(status).alias("status"), "rows")


def multi_file_load(spark: SparkSession, landing_dir: str, raw_dir: str,
                    file_map: dict[str, str] = FILE_TABLE_MAP,
                    parallelism: int = 4) -> DataFrame:
    """Load every mapped landing file into its raw table; skip missing files
    (any other error stops the load).

    Returns the load report (table_name, file_name, status, rows); the total
    is a ``sum(rows)`` over it.
    """
    def load(item):
        fname, table = item
        path = f"{raw_dir}/{table}"
        try:
            df = read_csv_text(spark, f"{landing_dir}/{fname}", table)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            # an older load of the table is still there: say so
            stale = versions.exists(spark, path)
            return load_report_row(spark, table, fname, "skipped, table is stale" if stale else "skipped", None)
        versions.publish(df, path)
        return load_report_row(spark, table, fname, "loaded", path)

    # the loads are independent write jobs: submit them concurrently so small
    # tables do not leave the cluster idle behind one large one
    with ThreadPoolExecutor(max_workers=min(parallelism, len(file_map))) as ex:
        parts = list(ex.map(load, file_map.items()))
    return reduce(DataFrame.unionByName, parts)


def chunked_write(df: DataFrame, path: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Write in files of at most ``chunk_rows`` rows; report rows and the bound."""
    df.write.mode("overwrite").option("maxRecordsPerFile", chunk_rows).parquet(path)
    per_file = (df.sparkSession.read.parquet(path)
                .groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")))
    return per_file.agg(F.sum("n").alias("rows"),
                        (F.coalesce(F.max("n"), F.lit(0)) <= chunk_rows).alias("within_chunk"))


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a model as a table and return the re-read table."""
    return versions.publish(df, path)


def view(df: DataFrame, name: str) -> DataFrame:
    """Register a model as a (session) view and read it back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


class TableRaw:
    """Raw tables by name, with the buckets they were written with."""

    NAMES = tuple(FILE_TABLE_MAP.values())

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def get(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def __getattr__(self, name: str) -> DataFrame:
        if name in FILE_TABLE_MAP.values():
            return self.get(name)
        raise AttributeError(name)


class ParquetRaw:
    """Raw tables read back from the raw database folder (one Parquet table each)."""

    def __init__(self, spark: SparkSession, raw_dir: str):
        self.spark, self.raw_dir = spark, raw_dir.rstrip("/")

    def get(self, name: str) -> DataFrame:
        return versions.read(self.spark, f"{self.raw_dir}/{name}")

    def __getattr__(self, name: str) -> DataFrame:
        if name in FILE_TABLE_MAP.values():
            return self.get(name)
        raise AttributeError(name)
