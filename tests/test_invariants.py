"""Whole-pipeline invariants on the small driver tables (SURVEY §5 (c))."""

from pyspark.sql import functions as F

from tidemart.catalog import Warehouse
from tidemart.plans import reports

SF = "/root/testdata/sf0.001"


def test_fact_keeps_every_order(spark):
    w = Warehouse(spark, SF)
    assert w.fct_orders.count() == w.stg_orders.count()
    assert w.fct_orders.select("order_id").distinct().count() == w.stg_orders.count()


def test_features_and_labels_cover_the_same_customers(spark):
    w = Warehouse(spark, SF)
    f = w.mart_customer_features.select("customer_id")
    lab = w.mart_churn_labels.select("customer_id")
    assert f.count() == lab.count() == f.join(lab, "customer_id").count()


def test_segment_shares_sum_to_100(spark):
    w = Warehouse(spark, SF)
    base = reports.order_customer_base(w.fct_orders, w.dim_customers)
    s = reports.rfm_segment_summary(reports.rfm_scores(base))
    tot = s.agg(F.sum("cus_pct"), F.sum("rev_pct"), F.sum("count")).first()
    assert abs(tot[0] - 100) < 0.5 and abs(tot[1] - 100) < 0.5
    assert tot[2] == base.select("customer_id").distinct().count()


def test_rfm_scores_match_pandas_qcut(spark):
    import pandas as pd
    w = Warehouse(spark, SF)
    base = reports.order_customer_base(w.fct_orders, w.dim_customers)
    got = reports.rfm_scores(base).toPandas().sort_values("customer_id").reset_index(drop=True)
    rfm = got[["customer_id", "recency", "frequency", "monetary"]].copy()
    def fifths(x, labels=range(1, 6)):
        return pd.qcut(x, 5, labels=list(labels)).astype(int)

    for name, want in {"r_score": fifths(rfm["recency"], range(5, 0, -1)),
                       "f_score": fifths(rfm["frequency"].rank(method="first")),
                       "m_score": fifths(rfm["monetary"].astype(float))}.items():
        assert (got[name] == want).all(), name


def test_rfm_by_real_buyer(spark):
    w = Warehouse(spark, SF)
    base = reports.order_customer_base(w.fct_orders, w.dim_customers, carry=("customer_unique_id",))
    got = reports.rfm_scores(base, key="customer_unique_id")
    assert got.columns[0] == "customer_unique_id"
    assert got.count() == base.select("customer_unique_id").distinct().count()


def test_mart_output_types(spark):
    w = Warehouse(spark, SF)
    fct, feats, labels = (dict(df.dtypes) for df in (
        w.fct_orders, w.mart_customer_features, w.mart_churn_labels))
    assert fct["purchased_at"] == fct["delivered_to_customer_at"] == "timestamp_ntz"
    assert fct["total_order_value"] == feats["monetary"] == "decimal(38,2)"
    assert fct["delivery_days"] == feats["recency_days"] == labels["days_since_last_order"] == "int"
    assert feats["frequency"] == labels["total_orders"] == "bigint"
    assert feats["avg_review_score"] == feats["late_delivery_rate"] == "double"
    assert feats["min_review_score"] == labels["is_churned"] == "int"
