"""Binary files in the shared work folder, written and read by tasks.

Spark has no sink for a binary format of our own, so tasks write the files
under names of their own attempt and return manifest rows; only the rows of
successful attempts reach the manifest table, which alone says what belongs to
the data. Any store that pyarrow can open will do for the shared folder.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from ..session import work_path


def new_folder(spark: SparkSession, name: str) -> str:
    return work_path(spark, "files", f"{name}-{uuid.uuid4().hex}")


def _open(path: str):
    from pyarrow import fs

    if re.match(r"file:|/", path):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return fs.FileSystem.from_uri(path)


def create(path: str):
    store, inner = _open(path)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    return store.open_output_stream(inner, compression=None)


def read(path: str):
    """A seekable input."""
    store, inner = _open(path)
    return store.open_input_file(inner)


def attempt_name(serial: int) -> str:
    """A file name no other task or attempt uses."""
    from pyspark import TaskContext

    t = TaskContext.get()
    return f"part-{t.partitionId():05d}-{t.taskAttemptId()}-{serial:04d}"
