"""The daily batch as one Spark driver program: load -> models -> checks.

1. every landing CSV is loaded into its raw table (full refresh);
2. the marts are built from the raw tables and written whole (dimensions and
   the fact first, then features and labels, which read the written fact), as
   named tables with a stable place: ``raw.orders``, ``marts.fct_orders``;
3. the data-quality suite runs on the written tables; any failing check fails
   the run (``RefreshFailed``) after the report is written.

Each step writes a new version of its table and is entered in a ledger, so a
lost executor costs a re-read of the last written table, a failed write leaves
the last run's rows in place, and a run that stopped goes on at the step that
failed (``retries`` times by itself, or when the batch is started again).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Warehouse
from ..schemas import FILE_TABLE_MAP
from ..sources import databases, files, versions
from ..sources.fixtures import RawTables
from . import marts, quality
from .ledger import Ledger, chain, digest, files_fingerprint

MART_ORDER = ("dim_customers", "dim_products", "dim_sellers", "fct_orders",
              "mart_customer_features", "mart_churn_labels")
#: What each model reads: raw tables and models built before it.
READS = {
    "dim_customers": ("customers",), "dim_products": ("products", "product_category_translation"),
    "dim_sellers": ("sellers",), "fct_orders": ("orders", "order_items", "order_payments"),
    "mart_customer_features": ("fct_orders", "dim_customers", "order_payments", "order_reviews"),
    "mart_churn_labels": ("fct_orders",),
}


#: Tables that are joined and grouped by order: dealt out and sorted by it when
#: written, so that no model of the batch shuffles them by order again.
BY_ORDER = ("orders", "order_items", "order_payments", "order_reviews", "fct_orders")
ORDER_BUCKETS = 64
#: Landing text of the largest of them per bucket: a task sorts and joins one.
BUCKET_BYTES = 64 << 20


class RefreshFailed(RuntimeError):
    pass


def refresh_all(spark: SparkSession, landing_dir: str, base_dir: str,
                fail_on_error: bool = True, fail_on_skipped: bool | None = None,
                raw_db: str = "raw", marts_db: str = "marts", retries: int = 0,
                retry_seconds: float = 0.0, parallelism: int = 4,
                order_buckets: int = ORDER_BUCKETS) -> DataFrame:
    """Run the batch; return the run report (step, name, status, rows).

    A missing landing file is an error if an older load of its table exists,
    which would be used stale; else it is skipped and reported.
    ``fail_on_skipped`` makes it an error (True) or a report (False) in both
    cases. Tables live under ``base_dir`` and replace the last run's. A step
    that an unfinished run has done is "reused". ``order_buckets``: the least
    number of files of the tables in ``BY_ORDER``; it is doubled until a bucket
    holds at most ``BUCKET_BYTES`` of the largest landing file.
    """
    for left in range(retries, -1, -1):
        try:
            return _run(spark, landing_dir, base_dir.rstrip("/"), fail_on_error, fail_on_skipped,
                        raw_db, marts_db, parallelism, order_buckets)
        except RefreshFailed:  # the data is at fault: another try gives the same
            raise
        except Exception:
            if not left:
                raise
            time.sleep(retry_seconds)
    raise AssertionError


def _rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def _buckets(table: str, count: int) -> databases.Buckets | None:
    return databases.Buckets("order_id", count) if table in BY_ORDER else None


def _folder_bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def bucket_count(spark: SparkSession, landing_dir: str, least: int) -> int:
    """Buckets of the tables in ``BY_ORDER``: ``least``, doubled until each holds
    at most ``BUCKET_BYTES`` of the largest landing file, so that what one task
    sorts does not grow with the input."""
    largest = max(_folder_bytes(spark, f"{landing_dir}/{f}") for f, t in FILE_TABLE_MAP.items() if t in BY_ORDER)
    count = least
    while count * BUCKET_BYTES < largest:
        count *= 2
    return count


def _load(spark, ledger: Ledger, landing_dir: str, base: str, raw_db: str,
          parallelism: int, order_buckets: int) -> dict[str, tuple[str, int, str]]:
    """Per raw table: status, rows and fingerprint."""
    def one(item):
        fname, table = item
        path = databases.table_path(base, raw_db, table)
        found = files_fingerprint(spark, f"{landing_dir}/{fname}")
        buckets = _buckets(table, order_buckets)
        if found is None:
            return table, ("skipped, table is stale" if versions.exists(spark, path) else "skipped", 0, "none")
        found = digest(found, str(buckets))
        state, rows = ledger.step("load", table, found, path, lambda: _rows(databases.replace_table(
            files.read_csv_text(spark, f"{landing_dir}/{fname}", table), raw_db, table, base, buckets)))
        return table, ("loaded" if state == "done" else "reused", rows, found)

    # independent write jobs: small tables do not wait behind a large one
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return dict(ex.map(one, FILE_TABLE_MAP.items()))


def _run(spark, landing_dir, base, fail_on_error, fail_on_skipped, raw_db, marts_db, parallelism, order_buckets) -> DataFrame:
    ledger = Ledger(spark, f"{base}/ledger")
    order_buckets = bucket_count(spark, landing_dir, order_buckets)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{raw_db}`")
    loaded = _load(spark, ledger, landing_dir, base, raw_db, parallelism, order_buckets)
    skipped = [t for t, (status, _, _) in loaded.items() if status.startswith("skipped")]
    wrong = [t for t in skipped if fail_on_skipped or (fail_on_skipped is None and "stale" in loaded[t][0])]
    if wrong:
        raise RefreshFailed(f"landing files are missing for {wrong}")
    raw = files.TableRaw(spark, raw_db)
    for t in RawTables.NAMES:
        if t not in skipped:
            databases.open_table(spark, raw_db, t, base, _buckets(t, order_buckets))
    w = Warehouse(spark, landing_dir, raw=raw)
    built: dict[str, DataFrame] = {}

    def model(m: str) -> DataFrame:
        if m == "mart_customer_features":
            return marts.mart_customer_features(built["fct_orders"], built["dim_customers"],
                                                w.stg_order_payments, w.stg_order_reviews)
        return marts.mart_churn_labels(built["fct_orders"]) if m == "mart_churn_labels" else w.model(m)

    prints = {t: fingerprint for t, (_, _, fingerprint) in loaded.items()}
    report = [("load", t, status, rows) for t, (status, rows, _) in loaded.items()]
    for m in MART_ORDER:
        buckets = _buckets(m, order_buckets)
        prints[m] = chain(m, [str(buckets), *[prints[r] for r in READS[m]]])
        work: Callable[[], int] = lambda m=m, b=buckets: _rows(
            databases.replace_table(model(m), marts_db, m, base, b))
        state, rows = ledger.step("model", m, prints[m], databases.table_path(base, marts_db, m), work)
        built[m] = databases.open_table(spark, marts_db, m, base, buckets)
        report.append(("model", m, "built" if state == "done" else "reused", rows))

    models = {m: built.get(m, w.model(m) if m.startswith("stg_") else None)
              for m, _ in quality.NOT_NULL_TESTS + quality.UNIQUE_TESTS}
    suite_path = f"{base}/checks"
    quality.suite(models, {n: raw.get(n) for n in RawTables.NAMES}).write.mode("overwrite").parquet(suite_path)
    checks = spark.read.parquet(suite_path)
    check_rep = checks.select(F.lit("check").alias("step"),
                              F.concat_ws(".", "test", "model", "column_name").alias("name"),
                              "status", F.col("failures").alias("rows"))
    ledger.finish()  # what the checks find needs new data, not another try
    if fail_on_error and checks.filter(F.col("status") == "fail").limit(1).count() > 0:
        raise RefreshFailed("data-quality checks failed; see " + suite_path)
    return spark.createDataFrame(report, "step string, name string, status string, rows long").unionByName(check_rep)
