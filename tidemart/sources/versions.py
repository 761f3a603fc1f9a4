"""Tables and models replaced whole, by versions.

A version is a folder ``v-<time>-<id>`` under the table's folder. Its content is
written first and counted; then an empty marker file commits it, in one step.
The newest committed version is the table. So a write that fails leaves the old
rows readable, a reader always finds one whole version, and nothing is renamed
(object stores have no rename). After a commit the versions before the last
``keep`` ones are removed, with what failed writes left behind before them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_MARK = "_committed"
#: Committed versions that stay: the newest and one for readers that began before it.
KEEP = 2


class NoVersion(FileNotFoundError):
    """The table was never written whole."""


class LostRows(RuntimeError):
    """A version does not hold what was written to it."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _child(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path, name)


def _all(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, committed) of every version, oldest first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("v-"))
    return [(n, fs.exists(_child(spark, f"{path}/{n}", _MARK))) for n in names]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest committed version."""
    path = path.rstrip("/")
    done = [n for n, committed in _all(spark, path) if committed]
    return f"{path}/{done[-1]}" if done else None


def new_version(path: str) -> str:
    return f"{path.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, version: str, keep: int = KEEP) -> None:
    """Make a written folder the current version and remove old ones."""
    fs, p = _fs(spark, version)
    fs.create(_child(spark, version, _MARK), False).close()
    path = version.rpartition("/")[0]
    found = _all(spark, path)
    done = [n for n, committed in found if committed]
    oldest = done[-keep] if len(done) >= keep else done[0]
    for name, _ in found:
        if name < oldest:
            fs.delete(_child(spark, path, name), True)


def publish(df: DataFrame, path: str, keep: int = KEEP,
            write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """Write ``df`` as the next version of the table and return it re-read.
    The rows read back are counted before the version counts."""
    spark = df.sparkSession
    version = new_version(path)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if write:
        write(counted, version)
    else:
        counted.write.parquet(version)
    out = spark.read.schema(df.schema).parquet(version)
    rows = out.agg(F.count(F.lit(1))).first()[0]
    if rows != seen.get["rows"]:
        raise LostRows(f"{version}: {seen.get['rows']} rows were written, {rows} are there")
    commit(spark, version, keep)
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's current version."""
    version = current(spark, path)
    if version is None:
        raise NoVersion(path)
    return spark.read.parquet(version)


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None
