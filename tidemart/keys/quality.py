"""Keys for the data-quality checks and the profiler."""

from __future__ import annotations

from ..catalog import Warehouse
from ..oracle import sql
from ..plans import quality as Q
from ..sources.fixtures import RawTables
from . import register

MODELS = sorted({m for m, _ in Q.NOT_NULL_TESTS + Q.UNIQUE_TESTS})


def _models(w: Warehouse) -> dict:
    return {m: w.model(m) for m in MODELS}


def _raw(w: Warehouse) -> dict:
    return {n: w.raw.get(n) for n in RawTables.NAMES}


def _not_null_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT 'not_null' AS test, '{m}' AS model, '{c}' AS column_name, "
        f"count_if({c} IS NULL) AS failures FROM {m}" for m, c in Q.NOT_NULL_TESTS)


def _unique_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT 'unique' AS test, '{m}' AS model, '{c}' AS column_name, count(*) AS failures "
        f"FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d"
        for m, c in Q.UNIQUE_TESTS)


def _row_counts_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM raw_{n}"
        for n in sorted(RawTables.NAMES))


@register("dq_not_null", sql(_not_null_sql()))
def dq_not_null(spark, sf_dir):
    return Q.not_null_results(_models(Warehouse(spark, sf_dir)))


@register("dq_unique", sql(_unique_sql()))
def dq_unique(spark, sf_dir):
    return Q.unique_results(_models(Warehouse(spark, sf_dir)))


@register("dq_row_counts", sql(_row_counts_sql()))
def dq_row_counts(spark, sf_dir):
    return Q.row_counts(_raw(Warehouse(spark, sf_dir)))


ORDERS_NULLS_SQL = """
SELECT count(*) AS total_rows, count(order_id) AS non_null_order_id,
       count(customer_id) AS non_null_customer_id, count(order_status) AS non_null_status,
       count(order_purchase_timestamp) AS non_null_purchase_ts
FROM raw_orders"""


@register("dq_orders_nulls", sql(ORDERS_NULLS_SQL))
def dq_orders_nulls(spark, sf_dir):
    return Q.orders_null_check(RawTables(spark, sf_dir).orders)


@register("dq_orders_duplicates", sql("""
SELECT order_id, count(*) AS cnt FROM raw_orders GROUP BY order_id HAVING count(*) > 1
ORDER BY order_id LIMIT 10"""))
def dq_orders_duplicates(spark, sf_dir):
    return Q.orders_duplicate_check(RawTables(spark, sf_dir).orders)


@register("dq_geo_duplicates", sql("""
SELECT geolocation_zip_code_prefix, count(*) AS cnt FROM raw_geolocation
GROUP BY geolocation_zip_code_prefix HAVING count(*) > 1
ORDER BY cnt DESC, geolocation_zip_code_prefix LIMIT 5"""))
def dq_geo_duplicates(spark, sf_dir):
    return Q.geolocation_duplicate_check(RawTables(spark, sf_dir).geolocation)


ORPHANS_SQL = """
SELECT count(*) AS orphan_count FROM raw_order_items oi
LEFT JOIN raw_orders o ON oi.order_id = o.order_id WHERE o.order_id IS NULL"""


@register("dq_orphan_items", sql(ORPHANS_SQL))
def dq_orphan_items(spark, sf_dir):
    r = RawTables(spark, sf_dir)
    return Q.orphan_order_items(r.order_items, r.orders)


_SUITE_SQL = f"""
SELECT test, model, column_name, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END
         AS status
FROM (
  SELECT *, 'error' AS severity FROM ({_not_null_sql()}) a
  UNION ALL SELECT *, 'error' FROM ({_unique_sql()}) b
  UNION ALL SELECT 'row_counts', 'raw', '*', count_if(row_count = 0), 'error'
            FROM ({_row_counts_sql()}) rc
  UNION ALL SELECT 'orders_null_check', 'raw.orders', '{",".join(Q.ORDER_NULL_COLUMNS)}',
            total_rows * 4 - non_null_order_id - non_null_customer_id - non_null_status
              - non_null_purchase_ts, 'error' FROM ({ORDERS_NULLS_SQL}) n
  UNION ALL SELECT 'orders_duplicate_check', 'raw.orders', 'order_id', count(*), 'error'
            FROM (SELECT order_id FROM raw_orders GROUP BY order_id HAVING count(*) > 1) d
  UNION ALL SELECT 'geolocation_duplicate_check', 'raw.geolocation',
            'geolocation_zip_code_prefix', count(*), 'warn'
            FROM (SELECT geolocation_zip_code_prefix FROM raw_geolocation
                  WHERE geolocation_zip_code_prefix IS NOT NULL
                  GROUP BY 1 HAVING count(*) > 1) g
  UNION ALL SELECT 'orphan_order_items', 'raw.order_items', 'order_id', orphan_count, 'error'
            FROM ({ORPHANS_SQL}) o
) s"""


@register("dq_suite", sql(_SUITE_SQL))
def dq_suite(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.suite(_models(w), _raw(w))


def _profile_sql() -> str:
    from ..schemas import RAW_COLUMNS
    parts = []
    for n in sorted(RawTables.NAMES):
        cols = RAW_COLUMNS[n]
        order = ", ".join(f"{c} NULLS LAST" for c in cols)
        for i, c in enumerate(cols):
            parts.append(
                f"SELECT '{n}' AS table_name, count(*) AS n_rows, {len(cols)} AS n_cols, "
                f"{i + 1} AS ordinal, '{c}' AS column_name, count_if({c} IS NULL) AS null_count, "
                f"(SELECT coalesce(string_agg(v, '|' ORDER BY nth), '') FROM (SELECT coalesce({c}, '') AS v, "
                f"row_number() OVER (ORDER BY {order}) AS nth FROM raw_{n}) s WHERE nth <= {Q.SAMPLE_ROWS}) AS sample "
                f"FROM raw_{n}")
    return " UNION ALL ".join(parts)


@register("profile_table", sql(_profile_sql()))
def profile_table(spark, sf_dir):
    return Q.profile(_raw(Warehouse(spark, sf_dir)))
