"""Every key with an oracle returns the same rows as DuckDB (small scale)."""

import decimal
import math

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (float, decimal.Decimal, int)) and not isinstance(v, bool):
        return float(f"{float(v):.9g}")
    if isinstance(v, bool):
        return float(v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


FAST = ["stg_orders", "fct_orders", "mart_customer_features", "mart_churn_labels", "rfm_scores",
        "review_by_delivery_bucket", "monthly_revenue", "top_categories", "dq_suite",
        "profile_table", "ml_roc_auc", "ml_pr_curve", "ml_risk_segments", "ml_median_impute",
        "csv_scan_text", "multi_file_load", "agg_quantile", "win_lag_gap", "rank_first"]


@pytest.mark.parametrize("key", FAST)
def test_key_matches_duckdb(spark, con, key):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())


def test_every_oracle_key_is_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and df.columns == ["month", "revenue", "orders"]


def test_registry_equals_survey_inventory():
    import importlib.util
    from pathlib import Path
    spec = importlib.util.spec_from_file_location(
        "keys_table", Path(__file__).resolve().parents[1] / "scripts" / "keys_table.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    from tidemart import keys
    keys.load_all()
    assert set(mod.survey_keys()) == set(keys.QUERIES)
