"""Run the batch: ``python -m tidemart --landing DIR --out DIR [--master URL]``.

Loads every landing CSV into the raw tables, builds and writes the marts, runs
the data-quality suite (a failing check exits non-zero) and prints the run
report. With ``--source`` the landing files are first exported from a folder
of driver tables (the test bed).
"""

from __future__ import annotations

import argparse
import sys

from .plans.refresh import RefreshFailed, refresh_all
from .session import build_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemart")
    ap.add_argument("--landing", help="folder holding the landing CSV files")
    ap.add_argument("--source", help="folder of driver Parquet tables to export first")
    ap.add_argument("--out", help="output folder (default: tidemart under the warehouse folder)")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if not a.landing and not a.source:
        ap.error("give --landing or --source")
    spark = build_session(a.master, app="tidemart-refresh")
    landing = a.landing
    if a.source:
        from .sources.files import landing_for
        from .sources.fixtures import RawTables
        raw = RawTables(spark, a.source)
        landing = landing_for(spark, a.source, {n: raw.get(n) for n in RawTables.NAMES})
    out = a.out or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tidemart"
    try:
        report = refresh_all(spark, landing, out, retries=1, retry_seconds=300.0)
    except RefreshFailed as e:
        print(f"refresh failed: {e}", file=sys.stderr)
        return 1
    report.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
