"""The run ledger of a batch: what each step read, wrote and how it ended.

One row per event (a JSON line in a folder of its own; added, never changed). A step's fingerprint
covers its inputs: for a load the files as they lie in the landing folder, for a
model the fingerprints of the steps it reads and ``RULES``. A run that failed is
gone on with: steps it finished with the same fingerprint, whose tables are
still at the version they wrote, are reused; from the first other step on all is
run. A finished run is never gone on with, so the next batch refreshes in full.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions

#: Raise it when a model's rules change, so that no older result is reused.
RULES = 1
_SCHEMA = ("run string, at long, step string, name string, state string, fingerprint string, "
           "version string, rows long, error string")


def digest(*parts: str) -> str:
    return hashlib.sha256("\x00".join(parts).encode()).hexdigest()[:32]


def files_fingerprint(spark: SparkSession, path: str) -> str | None:
    """Names, sizes and times of the files under ``path``; None if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        found.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return digest(*sorted(found))


def events(spark: SparkSession, path: str) -> DataFrame:
    """All events of the ledger under ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).json(f"{path}/*")


class Ledger:
    """The events under ``path``, and the run that this process adds to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        past = events(spark, path)
        last = past.orderBy(F.desc("at")).first()
        open_run = last is not None and past.filter(
            (F.col("run") == last["run"]) & (F.col("step") == "run") & (F.col("state") == "finished")).isEmpty()
        self.resumed = open_run
        self.run = last["run"] if open_run else uuid.uuid4().hex
        done = past.filter((F.col("run") == self.run) & (F.col("state") == "done")) if open_run else None
        # one row a step
        self._done = {(r["step"], r["name"]): r for r in done.orderBy("at").collect()} if open_run else {}
        self._event("run", "batch", "resumed" if open_run else "started")

    def _event(self, step: str, name: str, state: str, fingerprint: str | None = None,
               version: str | None = None, rows: int | None = None, error: str | None = None) -> None:
        row = (self.run, time.time_ns(), step, name, state, fingerprint, version, rows, error)
        # a folder of its own: loads run side by side, and writers of one folder would clean up after each other
        at = f"{self.path}/{row[1]:020d}-{uuid.uuid4().hex[:8]}"
        self.spark.createDataFrame([row], _SCHEMA).coalesce(1).write.json(at)

    def step(self, step: str, name: str, fingerprint: str, table: str, work: Callable[[], int]) -> tuple[str, int]:
        """("done" or "reused", rows): run ``work``, which writes the next
        version of ``table`` and returns its rows, unless this run has done so."""
        old = self._done.get((step, name))
        if (old is not None and old["fingerprint"] == fingerprint and old["version"] is not None
                and old["version"] == versions.current(self.spark, table)):
            return "reused", old["rows"]
        try:
            rows = work()
        except Exception as e:
            self._event(step, name, "failed", fingerprint, error=f"{type(e).__name__}: {e}"[:500])
            raise
        self._event(step, name, "done", fingerprint, versions.current(self.spark, table), rows)
        return "done", rows

    def finish(self) -> None:
        self._event("run", "batch", "finished")


def chain(name: str, inputs: Sequence[str]) -> str:
    """Fingerprint of a model from those of the steps it reads."""
    return digest(name, str(RULES), *inputs)
