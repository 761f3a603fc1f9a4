"""Spark session options and the shared work folder.

The library never assumes a machine-local folder on a cluster: every table it
writes (landing CSVs, raw tables, marts, models, passes) lives under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
missing (a laptop, a unit test) and the master is local do we create one under
the system temp folder; on a cluster master the missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Options the engine is designed around. ANSI stays on (bad casts fail the run,
# as PostgreSQL casts do); timestamps are NTZ end to end so no session time zone
# can shift a value; AQE re-plans joins and partitions from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tidemart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # a local session bound only by address loses large task results
            b = b.config("spark.driver.host", "127.0.0.1")
            b = b.config("spark.driver.bindAddress", "127.0.0.1")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(
                f"spark.checkpoint.dir is unset on master {master!r}: name a folder that the "
                "driver and all executors share; a machine-local folder would lose tables")
        d = tempfile.mkdtemp(prefix="tidemart-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_RUN_ID = uuid.uuid4().hex[:12]


_SCOPES: list[list[str]] = []


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path for written tables of this run, inside the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # inside the per-context uuid leaf of the checkpoint folder Spark returns, so
    # one run's files stay together
    path = "/".join([base, "tidemart", _RUN_ID, *parts])
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def work_scope(spark: SparkSession):
    """Tables that are written inside are removed at the end: put work in it
    whose result is written elsewhere before the end."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            remove(spark, path)
