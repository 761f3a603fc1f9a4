"""Named databases with a stable place: ``raw`` and ``marts`` tables that users
query as ``marts.fct_orders`` and that a later run finds and replaces. A table
is a folder of versions; its name points to the newest whole one."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import versions


def table_path(base: str, database: str, table: str) -> str:
    return f"{base.rstrip('/')}/{database}.db/{table}"


class Buckets(NamedTuple):
    """Rows dealt out by the hash of ``column`` into ``count`` files, each
    sorted by it: tables with equal buckets are joined and grouped by the column
    without a shuffle."""

    column: str
    count: int


def _write_bucketed(df: DataFrame, version: str, buckets: Buckets) -> None:
    name = f"bucketed_{uuid.uuid4().hex}"
    # one task per bucket, so one file per bucket
    (df.repartition(buckets.count, buckets.column).write.bucketBy(buckets.count, buckets.column)
       .sortBy(buckets.column).option("path", version).format("parquet").saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE `{name}`")  # external: its files stay


def _known(spark: SparkSession, database: str, table: str, schema: StructType, buckets: Buckets | None) -> bool:
    """Whether the catalog has the table with that very shape."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return False
    said = {r["col_name"]: r["data_type"] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").collect() if r["col_name"]}
    number = said.get("Num Buckets")
    have = (number, said.get("Bucket Columns")) if number else None
    want = (str(buckets.count), f"[`{buckets.column}`]") if buckets else None
    return have == want and spark.table(f"{database}.{table}").schema == schema


def _point(spark: SparkSession, database: str, table: str, location: str, buckets: Buckets | None) -> DataFrame:
    """Let the name stand for ``location``: one change of the catalog entry."""
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    schema = spark.read.parquet(location).schema
    if _known(spark, database, table, schema, buckets):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:  # new, or of another shape: the entry is replaced, the files stay
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        dealt = (f"CLUSTERED BY (`{buckets.column}`) SORTED BY (`{buckets.column}`) INTO {buckets.count} BUCKETS"
                 if buckets else "")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {dealt} LOCATION '{location}'")
    spark.catalog.refreshTable(f"{database}.{table}")
    return spark.table(f"{database}.{table}")


def replace_table(df: DataFrame, database: str, table: str, base: str, buckets: Buckets | None = None) -> DataFrame:
    """Write ``df`` as the table's next version under ``base`` and name it."""
    path = table_path(base, database, table)
    write = (lambda d, version: _write_bucketed(d, version, buckets)) if buckets else None
    versions.publish(df, path, write=write)
    return open_table(df.sparkSession, database, table, base, buckets)


def open_table(spark: SparkSession, database: str, table: str, base: str, buckets: Buckets | None = None) -> DataFrame:
    """Name a table that this or an earlier run wrote under ``base`` (with the
    ``buckets`` it was written with)."""
    path = table_path(base, database, table)
    location = versions.current(spark, path)
    if location is None:
        raise versions.NoVersion(path)
    return _point(spark, database, table, location, buckets)
