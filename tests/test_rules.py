"""Literal cases for the semantics the results depend on (FIXTURES.md §3)."""

from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemart.functions.bins import edge_bins, fixed_bins, rank_quintile
from tidemart.functions.temporal import elapsed_days
from tidemart.operators.scale import exact_quantiles
from tidemart.plans import marts, metrics, reports, staging
from tidemart.plans.churn import feature_correlation, risk_segments
from tidemart.plans.quality import duplicate_keys, not_null_results, unique_results
from tidemart.sources.files import na_to_null, read_csv_text

T0 = datetime(2020, 1, 1)


def test_elapsed_days_truncates(spark):
    rows = [(T0 + timedelta(hours=36), T0), (T0, T0 + timedelta(hours=36)),
            (T0 + timedelta(days=122.5), T0)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(elapsed_days(F.col("a"), F.col("b"))).collect()]
    assert got == [1, -1, 122]


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, "
                                 "purchased_at timestamp_ntz, approved_at timestamp_ntz, "
                                 "delivered_to_carrier_at timestamp_ntz, "
                                 "delivered_to_customer_at timestamp_ntz, "
                                 "estimated_delivery_at timestamp_ntz")


ITEMS = "order_id string, order_item_id string, product_id string, seller_id string, " \
        "shipping_limit_at timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)"
PAYS = "order_id string, payment_sequential int, payment_type string, " \
       "payment_installments int, payment_value decimal(10,2)"


def test_fact_no_children_null_and_fanout_not_multiplied(spark):
    o = _orders(spark, [("o1", "c1", "delivered", T0, None, None, T0 + timedelta(days=3), None),
                        ("o2", "c1", "delivered", T0, None, None, None, None)])
    items = spark.createDataFrame([("o1", "1", "p", "s", T0, Decimal("10.00"), Decimal("1.00")),
                                   ("o1", "2", "p", "s", T0, Decimal("5.00"), Decimal("2.00"))], ITEMS)
    pays = spark.createDataFrame([("o1", i, "credit_card", 2, Decimal("6.00")) for i in (1, 2, 3)],
                                 PAYS)
    f = {r["order_id"]: r for r in marts.fct_orders(o, items, pays).collect()}
    assert f["o1"]["item_count"] == 2 and f["o1"]["total_order_value"] == Decimal("18.00")
    assert f["o1"]["total_payment_value"] == Decimal("18.00")
    assert f["o1"]["delivery_days"] == 3
    assert f["o2"]["item_count"] is None and f["o2"]["total_payment_value"] is None
    assert f["o2"]["delivery_days"] is None


def test_feature_defaults_and_first_gap(spark):
    o = _orders(spark, [("o1", "c1", "delivered", T0, None, None, T0 + timedelta(days=2), None)])
    items = spark.createDataFrame([], ITEMS)
    pays = spark.createDataFrame([], PAYS)
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score int")
    cust = spark.createDataFrame([("c1", "u1", "00001", "x", "S")],
                                 "customer_id string, customer_unique_id string, zip_code string, "
                                 "city string, state string")
    fct = marts.fct_orders(o, items, pays)
    r = marts.mart_customer_features(fct, cust, pays, reviews).collect()[0]
    assert (r["avg_installments"], r["credit_card_rate"]) == (1.0, 0.0)
    assert (r["avg_review_score"], r["min_review_score"], r["bad_review_rate"]) == (3.0, 3, 0.0)
    assert r["avg_purchase_gap_days"] is None
    # missing estimate: not late
    assert r["late_delivery_rate"] == 0.0


def test_churn_edge(spark):
    ref = T0 + timedelta(days=200)
    o = _orders(spark, [("o0", "c0", "delivered", ref, None, None, None, None),
                        ("o1", "c1", "delivered", ref - timedelta(days=90), None, None, None, None),
                        ("o2", "c2", "delivered", ref - timedelta(days=91), None, None, None, None)])
    lab = {r["customer_id"]: r["is_churned"] for r in marts.mart_churn_labels(o).collect()}
    assert lab == {"c0": 0, "c1": 0, "c2": 1}


def test_empty_sum_is_zero_in_reports(spark):
    base = spark.createDataFrame([("o1", T0, None)],
                                 "order_id string, purchased_at timestamp_ntz, "
                                 "total_order_value decimal(21,2)")
    r = reports.monthly_revenue(base).collect()[0]
    assert r["revenue"] == 0 and r["orders"] == 1


def test_na_markers_and_quoted_newline(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('review_id,order_id,review_score,review_comment_title,review_comment_message,'
                 'review_creation_date,review_answer_timestamp\n'
                 'r1,o1,5,NA,"line one\nsaid ""hi""",null,NaN\n'
                 'r2,o2,4,,ok,2020-01-01 00:00:00,\n')
    rows = read_csv_text(spark, str(p), "order_reviews").orderBy("review_id").collect()
    assert len(rows) == 2
    assert rows[0]["review_comment_title"] is None
    assert rows[0]["review_comment_message"] == 'line one\nsaid "hi"'
    assert rows[0]["review_creation_date"] is None and rows[0]["review_answer_timestamp"] is None
    assert rows[1]["review_comment_title"] is None
    df = spark.createDataFrame([("N/A",), ("x",)], "a string")
    assert [r[0] for r in na_to_null(df).collect()] == [None, "x"]


def test_bad_cast_raises(spark):
    df = spark.createDataFrame([("",)], "price string")
    with pytest.raises(Exception):
        df.select(F.col("price").cast("decimal(10,2)")).collect()


def test_round_half_even(spark):
    assert spark.range(1).select(F.bround(F.lit(0.25), 1)).first()[0] == 0.2


def test_value_quintile_edges_and_duplicates(spark):
    df = spark.createDataFrame([(float(v), str(i)) for i, v in enumerate([1, 2, 4, 8, 16, 32, 64])],
                               "x double, k string")
    q = exact_quantiles(df, "x", [0.2, 0.4, 0.6, 0.8])
    got = sorted((r["p"], round(r["q"], 9)) for r in q.collect())
    assert [g[1] for g in got] == [2.4, 5.6, 12.8, 28.8]
    expect = pd.Series([1, 2, 4, 8, 16, 32, 64]).quantile([0.2, 0.4, 0.6, 0.8]).round(9).tolist()
    assert [g[1] for g in got] == expect
    dup = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "x double")
    edges = [F.lit(1.0), F.lit(1.0), F.lit(2.0)]
    with pytest.raises(Exception):
        dup.select(edge_bins(F.col("x"), edges)).collect()


def test_rank_quintiles_match_pandas(spark):
    for n in (2, 5, 7, 13, 100, 399):
        df = spark.range(1, n + 1).select(F.col("id").alias("r"))
        got = [r[0] for r in df.orderBy("r").select(rank_quintile(F.col("r"), F.lit(n))).collect()]
        exp = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
        assert got == exp, n
    assert [1, 1, 2, 3, 4, 5, 5] == pd.qcut(pd.Series(range(1, 8)), 5,
                                            labels=[1, 2, 3, 4, 5]).astype(int).tolist()


def test_fixed_bins_right_closed(spark):
    vals = [0, 0.5, 7, 8, 14, 21, 22, 999, 1000, -1]
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(vals)], "x double, i int")
    got = [r[0] for r in df.orderBy("i").select(
        fixed_bins(F.col("x"), [0, 7, 14, 21, 999], ["a", "b", "c", "d"])).collect()]
    assert got == [None, "a", "a", "b", "b", "c", "d", "d", None, None]


def test_segments_never_at_risk(spark):
    df = spark.createDataFrame([(r, f) for r in range(1, 6) for f in range(1, 6)], "r int, f int")
    seg = {(x["r"], x["f"]): x["s"] for x in
           df.select("r", "f", reports.segment(F.col("r"), F.col("f")).alias("s")).collect()}
    assert "At Risk" not in seg.values()
    assert seg[(5, 5)] == "Champions" and seg[(1, 3)] == "Loyal" and seg[(4, 1)] == "New"
    assert seg[(2, 2)] == "Lost" and seg[(3, 2)] == "Potential"


def test_constant_column_corr_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 1)], "frequency int, is_churned int")
    r = {x["feature"]: x["correlation"] for x in feature_correlation(df).collect()}
    assert r["frequency"] is None


def test_risk_bins_edges(spark):
    probs = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(probs)],
                               "customer_id string, churn_probability double")
    seg = risk_segments(df).orderBy("churn_probability").collect()
    p33, p66 = pd.Series(probs).quantile(0.33), pd.Series(probs).quantile(0.66)
    exp = pd.cut(pd.Series(probs), [0, p33, p66, 1.0], labels=["Low Risk", "Medium Risk",
                                                                "High Risk"],
                 include_lowest=True).astype(str).tolist()
    assert [r["risk_segment"] for r in seg] == exp
    assert seg[0]["recommended_action"] == "Standard newsletter"


def test_auc_ties_half_credit(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.875)


def test_best_threshold_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1)], "label int, score double")
    best = metrics.best_threshold(metrics.pr_curve(df)).first()
    assert best["threshold"] == 0.8 and best["recall"] == 1.0


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    models = {"m": df}
    nn = not_null_results(models, [("m", "k")]).first()
    un = unique_results(models, [("m", "k")]).first()
    assert nn["failures"] == 2 and un["failures"] == 1
    assert duplicate_keys(df, "k").count() == 1


def test_staging_spelling_fixed(spark):
    from tidemart.schemas import RAW_COLUMNS
    raw = spark.createDataFrame([tuple(["p1", "cat", "10", "20", "1", "1.5", "1", "2", "3"])],
                                ", ".join(f"{c} string" for c in RAW_COLUMNS["products"]))
    s = staging.stg_products(raw)
    assert s.columns[2:4] == ["name_length", "description_length"]
    assert s.first()["weight_g"] == Decimal("1.50")


def test_suite_statuses(spark):
    from tidemart.plans.quality import suite
    from tidemart.schemas import RAW_COLUMNS

    def raw(name, rows):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS[name]))

    orders = raw("orders", [("o1", "c1", "delivered", "2020-01-01 00:00:00", None, None, None, None),
                            ("o1", "c1", "delivered", "2020-01-01 00:00:00", None, None, None, None)])
    items = raw("order_items", [("o2", "1", "p", "s", None, "1.00", "1.00")])
    geo = raw("geolocation", [("00001", "1", "1", "x", "S"), ("00001", "1", "1", "x", "S")])
    others = {n: raw(n, []) for n in RAW_COLUMNS if n not in ("orders", "order_items", "geolocation")}
    raws = {"orders": orders, "order_items": items, "geolocation": geo, **others}
    key_df = spark.createDataFrame([("a",)], "k string")
    models = {m: key_df for m in ("stg_orders", "stg_customers", "stg_order_items",
                                  "stg_order_payments", "stg_order_reviews", "fct_orders",
                                  "dim_customers", "dim_products")}
    models = {m: key_df.select(*[F.col("k").alias(c) for c in
                                 ("order_id", "customer_id", "product_id", "payment_value",
                                  "review_id", "review_score")]) for m in models}
    st = {r["test"]: r["status"] for r in suite(models, raws).collect()
          if r["model"].startswith("raw")}
    assert st["orders_duplicate_check"] == "fail"
    assert st["orphan_order_items"] == "fail"
    assert st["geolocation_duplicate_check"] == "warn"
    assert st["row_counts"] == "fail"   # empty raw tables


def test_gap_lag_matches_plain_window_on_hot_customer(spark):
    from pyspark.sql import Window

    from tidemart.functions.temporal import elapsed_days
    rows = [(f"o{i}", "hot" if i % 3 == 0 else f"c{i % 17}", "delivered",
             T0 + timedelta(hours=7 * i), None, None, None, None) for i in range(300)]
    fct = marts.fct_orders(_orders(spark, rows), spark.createDataFrame([], ITEMS),
                           spark.createDataFrame([], PAYS))
    w = Window.partitionBy("customer_id").orderBy("purchased_at", "order_id")
    plain = fct.select("order_id", elapsed_days(
        F.col("purchased_at"), F.lag("purchased_at").over(w)).alias("purchase_gap_days"))
    got = marts.orders_with_gap(fct).select("order_id", "purchase_gap_days")
    assert sorted(got.collect()) == sorted(plain.collect())
