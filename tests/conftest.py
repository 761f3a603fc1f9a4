import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidemart.session import build_session
    s = build_session("local[4]", app="tidemart-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_tables_left():
    """Each file finds a session without named tables: those of the batch would
    stand for the models that a statement of another file names."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    for db in s.catalog.listDatabases() if s else ():
        if db.name != "default":
            s.sql(f"DROP DATABASE `{db.name}` CASCADE")
