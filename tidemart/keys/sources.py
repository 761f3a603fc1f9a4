"""Keys for scans, sources, sinks and materialisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Warehouse
from ..oracle import sql
from ..schemas import FILE_TABLE_MAP
from ..session import work_path
from ..sources import files, statements, versions
from ..sources.fixtures import RawTables
from . import register

ORDERS_FILE = "olist_orders_dataset.csv"
PAYMENTS_FILE = "olist_order_payments_dataset.csv"
MART_TABLES = ("dim_customers", "dim_products", "dim_sellers", "fct_orders",
               "mart_customer_features", "mart_churn_labels")


def _landing(spark, sf_dir) -> str:
    raw = RawTables(spark, sf_dir)
    return files.landing_for(spark, sf_dir, {n: raw.get(n) for n in RawTables.NAMES})


def _tag(sf_dir):
    return files.source_tag(sf_dir)


@register("csv_scan_text", sql("SELECT * FROM raw_orders"))
def csv_scan_text(spark, sf_dir):
    return files.read_csv_text(spark, f"{_landing(spark, sf_dir)}/{ORDERS_FILE}", "orders")


@register("csv_scan_inferred", sql("""
SELECT CAST(order_id AS BIGINT) AS order_id,
       CAST(payment_sequential AS BIGINT) AS payment_sequential, payment_type,
       CAST(payment_installments AS BIGINT) AS payment_installments,
       CAST(payment_value AS DOUBLE) AS payment_value
FROM raw_order_payments"""))
def csv_scan_inferred(spark, sf_dir):
    return files.read_csv_inferred(spark, f"{_landing(spark, sf_dir)}/{PAYMENTS_FILE}")


@register("multi_file_load", sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{f}' AS file_name, 'loaded' AS status, count(*) AS rows "
    f"FROM raw_{t}" for f, t in FILE_TABLE_MAP.items())))
def multi_file_load(spark, sf_dir):
    raw_dir = work_path(spark, "warehouse", _tag(sf_dir), "multi_file_load")
    return files.multi_file_load(spark, _landing(spark, sf_dir), raw_dir)


@register("raw_table_scan", sql("SELECT * FROM raw_orders"))
def raw_table_scan(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    path = work_path(spark, "warehouse", _tag(sf_dir), "raw_table_scan", "orders")
    files.full_refresh_load(files.read_csv_text(spark, f"{landing}/{ORDERS_FILE}", "orders"), path)
    return versions.read(spark, path)


@register("model_ref_scan", sql("SELECT * FROM fct_orders"))
def model_ref_scan(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    path = work_path(spark, "warehouse", _tag(sf_dir), "model_ref_scan", "fct_orders")
    return files.materialise(w.model("fct_orders"), path)


REVIEW_EXTRACT = """
SELECT o.order_id, CAST(o.purchased_at AS {text}) AS purchased_at, o.delivery_days,
       CAST(r.review_score AS INT) AS review_score
FROM {marts}fct_orders o
JOIN {raw}order_reviews AS r ON r.order_id = o.order_id
WHERE r.review_score IS NOT NULL AND o.delivery_days IS NOT NULL
"""


@register("sql_query_scan", sql("SELECT order_id, CAST(purchased_at AS TIMESTAMP) AS purchased_at, delivery_days, "
                                "review_score FROM (" + REVIEW_EXTRACT.format(marts="", raw="raw_", text="VARCHAR") + ")"))
def sql_query_scan(spark, sf_dir):
    """A statement over the named models, its text dates parsed."""
    return statements.read_sql(spark, REVIEW_EXTRACT.format(marts="marts.", raw="raw.", text="STRING"),
                               Warehouse(spark, sf_dir), parse_dates=["purchased_at"])


@register("full_refresh_load", sql("SELECT 'orders' AS table_name, count(*) AS rows FROM raw_orders"))
def full_refresh_load(spark, sf_dir):
    raw = RawTables(spark, sf_dir)
    path = work_path(spark, "warehouse", _tag(sf_dir), "refresh", "orders")
    files.full_refresh_load(raw.orders, path)            # first load creates
    counted = files.full_refresh_load(raw.orders, path)  # second replaces, same rows
    return counted.select(F.lit("orders").alias("table_name"), "rows")


@register("chunked_write", sql(
    "SELECT 'order_items' AS table_name, count(*) AS rows, true AS within_chunk "
    "FROM raw_order_items"))
def chunked_write(spark, sf_dir):
    raw = RawTables(spark, sf_dir)
    path = work_path(spark, "warehouse", _tag(sf_dir), "chunked", "order_items")
    return files.chunked_write(raw.order_items, path, chunk_rows=10_000).select(
        F.lit("order_items").alias("table_name"), "rows", "within_chunk")


@register("view_materialise", sql("SELECT * FROM stg_orders"))
def view_materialise(spark, sf_dir):
    return files.view(Warehouse(spark, sf_dir).stg_orders, f"stg_orders_{_tag(sf_dir)}")


@register("table_materialise", sql(" UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS rows FROM {m}" for m in MART_TABLES)))
def table_materialise(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    parts = []
    for m in MART_TABLES:
        path = work_path(spark, "warehouse", _tag(sf_dir), "table_materialise", m)
        t = files.materialise(w.model(m), path)
        setattr(w, m, t)  # models that follow read the table, they do not build it again
        parts.append(t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(m).alias("model"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def _refresh_sql() -> str:
    from .quality import _SUITE_SQL
    from ..plans.refresh import MART_ORDER
    load = " UNION ALL ".join(
        f"SELECT 'load' AS step, '{t}' AS name, 'loaded' AS status, count(*) AS rows FROM raw_{t}"
        for t in FILE_TABLE_MAP.values())
    built = " UNION ALL ".join(
        f"SELECT 'model', '{m}', 'built', count(*) FROM {m}" for m in MART_ORDER)
    checks = (f"SELECT 'check', concat_ws('.', test, model, column_name), status, failures "
              f"FROM ({_SUITE_SQL}) s")
    return sql(f"{load} UNION ALL {built} UNION ALL {checks}")


@register("refresh_all", _refresh_sql())
def refresh_all(spark, sf_dir):
    from ..plans.refresh import refresh_all as run
    return run(spark, _landing(spark, sf_dir),
               work_path(spark, "warehouse", _tag(sf_dir), "batch"),
               raw_db=f"raw_{_tag(sf_dir)}", marts_db=f"marts_{_tag(sf_dir)}", order_buckets=4)
