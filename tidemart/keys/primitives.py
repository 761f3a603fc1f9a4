"""Keys for the primitive operators.

Each key shows one operator on the whole tables, in the place the source
project uses it (a staging cast, a fact join, a report aggregate, ...).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..catalog import Warehouse
from ..functions.bins import fixed_bins
from ..functions.temporal import add_days, interval_parts, month_text
from ..oracle import sql
from ..plans import marts as MT
from ..plans import quality as Q
from ..plans import reports as R
from ..plans import sketches as S
from ..operators.positions import write_and_reread
from ..operators.scale import exact_quantiles, row_numbers
from ..session import work_path
from . import churn as _churn  # noqa: F401  (registers the ML CTEs)
from . import register
from . import reports as RK

W = Warehouse


# ------------------------------------------------ projections and casts
@register("project_rename", sql("SELECT * FROM stg_customers"))
def project_rename(spark, sf_dir):
    return W(spark, sf_dir).stg_customers


STAR_CTE = """
WITH source AS (SELECT * FROM {raw}),
renamed AS (
  SELECT order_id, customer_id, order_status,
         CAST(order_purchase_timestamp AS {ts}) AS purchased_at,
         CAST(order_approved_at AS {ts}) AS approved_at,
         CAST(order_delivered_carrier_date AS {ts}) AS delivered_to_carrier_at,
         CAST(order_delivered_customer_date AS {ts}) AS delivered_to_customer_at,
         CAST(order_estimated_delivery_date AS {ts}) AS estimated_delivery_at
  FROM source)
SELECT * FROM renamed
"""


@register("project_star_cte", sql("SELECT * FROM stg_orders"))
def project_star_cte(spark, sf_dir):
    # the frame is passed by name: no session-wide view is left
    return spark.sql(STAR_CTE.format(raw="{orders}", ts="TIMESTAMP_NTZ"), orders=W(spark, sf_dir).raw.orders)


@register("project_subset", sql("SELECT * FROM dim_customers"))
def project_subset(spark, sf_dir):
    return W(spark, sf_dir).dim_customers


@register("cast_timestamp", sql("""
SELECT order_id, purchased_at, approved_at, delivered_to_carrier_at, delivered_to_customer_at,
       estimated_delivery_at FROM stg_orders"""))
def cast_timestamp(spark, sf_dir):
    return W(spark, sf_dir).stg_orders.drop("customer_id", "order_status")


@register("cast_decimal", sql("SELECT order_id, order_item_id, price, freight_value FROM stg_order_items"))
def cast_decimal(spark, sf_dir):
    return W(spark, sf_dir).stg_order_items.select("order_id", "order_item_id", "price",
                                                   "freight_value")


@register("cast_int", sql(
    "SELECT product_id, name_length, description_length, photos_qty FROM stg_products"))
def cast_int(spark, sf_dir):
    return W(spark, sf_dir).stg_products.select("product_id", "name_length",
                                                "description_length", "photos_qty")


@register("cast_float", sql("""
SELECT customer_id,
       CAST(sum(CASE WHEN delivered_to_customer_at > estimated_delivery_at THEN 1 ELSE 0 END)
            AS DOUBLE) AS late_orders
FROM fct_orders WHERE order_status = 'delivered' GROUP BY customer_id"""))
def cast_float(spark, sf_dir):
    f = W(spark, sf_dir).fct_orders.filter(F.col("order_status") == "delivered")
    late = F.when(F.col("delivered_to_customer_at") > F.col("estimated_delivery_at"), 1).otherwise(0)
    return f.groupBy("customer_id").agg(F.sum(late).cast("double").alias("late_orders"))


@register("case_when", sql("""
SELECT order_id, delivery_days,
       CASE WHEN delivered_to_customer_at > estimated_delivery_at THEN 1 ELSE 0 END AS late_flag
FROM fct_orders"""))
def case_when(spark, sf_dir):
    f = W(spark, sf_dir).fct_orders
    return f.select("order_id", "delivery_days",
                    F.when(F.col("delivered_to_customer_at") > F.col("estimated_delivery_at"), 1)
                     .otherwise(0).alias("late_flag"))


@register("coalesce_default", sql("SELECT product_id, category_name_en FROM dim_products"))
def coalesce_default(spark, sf_dir):
    return W(spark, sf_dir).dim_products.select("product_id", "category_name_en")


@register("nullif_guard", sql("""
SELECT customer_id,
       CAST(sum(CASE WHEN delivered_to_customer_at > estimated_delivery_at THEN 1 ELSE 0 END)
            AS DOUBLE) / nullif(count(*), 0) AS late_delivery_rate
FROM fct_orders WHERE order_status = 'delivered' GROUP BY customer_id"""))
def nullif_guard(spark, sf_dir):
    f = W(spark, sf_dir).fct_orders.filter(F.col("order_status") == "delivered")
    return f.groupBy("customer_id").agg(
        MT.rate(F.col("delivered_to_customer_at") > F.col("estimated_delivery_at"))
        .alias("late_delivery_rate"))


@register("fillna_const", sql(
    "SELECT customer_id, coalesce(customer_state, 'Unknown') AS customer_state "
    "FROM mart_customer_features"))
def fillna_const(spark, sf_dir):
    return W(spark, sf_dir).mart_customer_features.select("customer_id", "customer_state") \
        .fillna({"customer_state": "Unknown"})


@register("arith_columns", sql("""
SELECT order_id, order_item_id, price + freight_value AS item_value,
       CAST(freight_value AS DOUBLE) / nullif(CAST(price + freight_value AS DOUBLE), 0) * 100
         AS freight_pct
FROM stg_order_items"""))
def arith_columns(spark, sf_dir):
    i = W(spark, sf_dir).stg_order_items
    total = F.col("price") + F.col("freight_value")
    return i.select("order_id", "order_item_id", total.alias("item_value"),
                    (F.try_divide(F.col("freight_value").cast("double"), total.cast("double"))
                     * 100).alias("freight_pct"))


@register("filter_equality", sql(
    "SELECT order_id, customer_id, purchased_at FROM fct_orders WHERE order_status = 'delivered'"))
def filter_equality(spark, sf_dir):
    return W(spark, sf_dir).fct_orders.filter(F.col("order_status") == "delivered") \
        .select("order_id", "customer_id", "purchased_at")


@register("filter_not_equal", sql(
    "SELECT product_id, category_name_en FROM dim_products WHERE category_name_en != 'uncategorized'"))
def filter_not_equal(spark, sf_dir):
    return W(spark, sf_dir).dim_products.filter(F.col("category_name_en") != "uncategorized") \
        .select("product_id", "category_name_en")


@register("filter_null_tests", sql("""
SELECT count_if(delivered_to_customer_at IS NULL) AS without_delivery,
       count_if(delivered_to_customer_at IS NOT NULL) AS with_delivery,
       count_if(delivery_days IS NOT NULL AND total_order_value IS NOT NULL) AS complete
FROM fct_orders"""))
def filter_null_tests(spark, sf_dir):
    f = W(spark, sf_dir).fct_orders
    return f.agg(
        F.count_if(F.col("delivered_to_customer_at").isNull()).alias("without_delivery"),
        F.count_if(F.col("delivered_to_customer_at").isNotNull()).alias("with_delivery"),
        F.count_if(F.col("delivery_days").isNotNull() & F.col("total_order_value").isNotNull())
         .alias("complete"))


@register("filter_threshold", sql(
    "SELECT customer_id, days_since_last_order FROM mart_churn_labels "
    "WHERE days_since_last_order > 90"))
def filter_threshold(spark, sf_dir):
    return W(spark, sf_dir).mart_churn_labels.filter(F.col("days_since_last_order") > 90) \
        .select("customer_id", "days_since_last_order")


@register("predicate_col_vs_col", sql(
    "SELECT order_id, coalesce(delivered_to_customer_at > estimated_delivery_at, false) AS is_late "
    "FROM fct_orders"))
def predicate_col_vs_col(spark, sf_dir):
    return W(spark, sf_dir).fct_orders.select(
        "order_id", R.is_late(F.col("delivered_to_customer_at"),
                              F.col("estimated_delivery_at")).alias("is_late"))


# ------------------------------------------------------------- joins
@register("join_inner_equi", sql("SELECT * FROM order_customer_base"))
def join_inner_equi(spark, sf_dir):
    return RK.base(spark, sf_dir)[1]


@register("join_left_preagg", sql("SELECT * FROM fct_orders"))
def join_left_preagg(spark, sf_dir):
    return W(spark, sf_dir).fct_orders


@register("join_left_lookup", sql("SELECT * FROM dim_products"))
def join_left_lookup(spark, sf_dir):
    return W(spark, sf_dir).dim_products


@register("join_multiway_mixed", sql("SELECT * FROM mart_customer_features"))
def join_multiway_mixed(spark, sf_dir):
    return W(spark, sf_dir).mart_customer_features


@register("join_anti", sql("""
SELECT count(*) AS orphan_count FROM raw_order_items oi
LEFT JOIN raw_orders o ON oi.order_id = o.order_id WHERE o.order_id IS NULL"""))
def join_anti(spark, sf_dir):
    w = W(spark, sf_dir)
    return Q.orphan_order_items(w.raw.order_items, w.raw.orders)


@register("join_fanout", sql(
    "SELECT customer_id, avg_installments, credit_card_rate FROM payers"))
def join_fanout(spark, sf_dir):
    w = W(spark, sf_dir)
    return MT.payment_features(w.fct_orders, w.stg_order_payments)


@register("scalar_subquery", sql(
    "SELECT customer_id, ref_date, days_since_last_order FROM mart_churn_labels"))
def scalar_subquery(spark, sf_dir):
    return W(spark, sf_dir).mart_churn_labels.select("customer_id", "ref_date",
                                                     "days_since_last_order")


# ------------------------------------------------------- aggregations
@register("agg_group_sum_max", sql("""
SELECT order_id, CAST(paid AS DECIMAL(38,2)) AS total_payment_value,
       installments AS max_installments FROM order_payments"""))
def agg_group_sum_max(spark, sf_dir):
    return MT.payment_totals(W(spark, sf_dir).stg_order_payments)


@register("agg_group_expr", sql("""
SELECT order_id, n_items AS item_count, CAST(goods AS DECIMAL(38,2)) AS total_price,
       CAST(freight AS DECIMAL(38,2)) AS total_freight_value,
       CAST(total AS DECIMAL(38,2)) AS total_order_value FROM order_items"""))
def agg_group_expr(spark, sf_dir):
    return MT.item_totals(W(spark, sf_dir).stg_order_items)


@register("agg_count_distinct", sql("""
SELECT customer_id, count(DISTINCT order_id) AS total_orders
FROM fct_orders WHERE order_status = 'delivered' GROUP BY customer_id"""))
def agg_count_distinct(spark, sf_dir):
    f = W(spark, sf_dir).fct_orders.filter(F.col("order_status") == "delivered")
    return f.groupBy("customer_id").agg(F.count_distinct("order_id").alias("total_orders"))


@register("agg_approx_distinct", sql("""
SELECT CAST(year(purchased_at) AS INTEGER) AS year, count(*) AS orders,
       count(DISTINCT customer_id) AS customers, true AS within_bound
FROM fct_orders WHERE purchased_at IS NOT NULL GROUP BY 1"""))
def agg_approx_distinct(spark, sf_dir):
    """Customers per year, exactly, and whether the sketches of the year's
    months, stored and merged, give that number within their error bound."""
    f = W(spark, sf_dir).fct_orders.filter("purchased_at is not null").select("purchased_at", "customer_id")
    months = S.store(S.distinct_sketches(f, [F.trunc("purchased_at", "month").alias("month")], ["customer_id"]),
                     work_path(spark, "sketches", uuid.uuid4().hex))
    years = S.estimates(S.merge(months, [F.year("month").alias("year")]))
    exact = f.groupBy(F.year("purchased_at").alias("year")).agg(F.count_distinct("customer_id").alias("customers"))
    off = F.abs(F.col("approx_customer_id") - F.col("customers")) / F.col("customers")
    return years.join(exact, "year").select("year", F.col("rows").alias("orders"), "customers",
                                            (off <= S.error_bound()).alias("within_bound"))


@register("agg_avg_min", sql("""
SELECT customer_id, avg_review_score, min_review_score, bad_review_rate FROM reviewers"""))
def agg_avg_min(spark, sf_dir):
    w = W(spark, sf_dir)
    return MT.review_features(w.fct_orders, w.stg_order_reviews)


@register("agg_conditional_rate", sql(
    "SELECT customer_id, late_delivery_rate, credit_card_rate, bad_review_rate "
    "FROM mart_customer_features"))
def agg_conditional_rate(spark, sf_dir):
    return W(spark, sf_dir).mart_customer_features.select(
        "customer_id", "late_delivery_rate", "credit_card_rate", "bad_review_rate")


@register("agg_global_nulls", sql("""
SELECT count(*) AS total_rows, count(order_id) AS non_null_order_id,
       count(customer_id) AS non_null_customer_id, count(order_status) AS non_null_status,
       count(order_purchase_timestamp) AS non_null_purchase_ts
FROM raw_orders"""))
def agg_global_nulls(spark, sf_dir):
    return Q.orders_null_check(W(spark, sf_dir).raw.orders)


@register("agg_global_max", sql("SELECT last_at AS ref_date FROM latest"))
def agg_global_max(spark, sf_dir):
    return MT.ref_date_frame(W(spark, sf_dir).fct_orders)


@register("macro_ref_date", sql("SELECT last_at AS ref_date FROM latest"))
def macro_ref_date(spark, sf_dir):
    return MT.ref_date_frame(W(spark, sf_dir).fct_orders)


@register("agg_min_max_span", sql("""
SELECT count(*) AS orders, min(purchased_at) AS first_purchase, max(purchased_at) AS last_purchase
FROM order_customer_base"""))
def agg_min_max_span(spark, sf_dir):
    b = RK.base(spark, sf_dir)[1]
    return b.agg(F.count(F.lit(1)).alias("orders"), F.min("purchased_at").alias("first_purchase"),
                 F.max("purchased_at").alias("last_purchase"))


@register("agg_having", sql("""
SELECT order_id, order_item_id, count(*) AS cnt FROM raw_order_items
GROUP BY order_id, order_item_id HAVING count(*) > 1"""))
def agg_having(spark, sf_dir):
    i = W(spark, sf_dir).raw.order_items
    return i.groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("cnt")) \
            .filter(F.col("cnt") > 1)


@register("agg_bool_mean", sql("""
SELECT CAST(sum(CAST(is_late AS INTEGER)) AS DOUBLE) / count(is_late) * 100 AS late_pct
FROM delivered_orders"""))
def agg_bool_mean(spark, sf_dir):
    d = R.delivered_orders(RK.base(spark, sf_dir)[1])
    return d.agg(R.pct(F.col("is_late")).alias("late_pct"))


STATE_STATS_SQL = """
SELECT state, CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS avg_days,
       CAST(sum(CAST(is_late AS INTEGER)) AS DOUBLE) / count(is_late) * 100 AS late_pct,
       count(order_id) AS order_count
FROM delivered_orders WHERE state IS NOT NULL GROUP BY state"""


@register("agg_named", sql(STATE_STATS_SQL))
def agg_named(spark, sf_dir):
    return R.delivery_by_state(RK.base(spark, sf_dir)[1], min_orders=0)


@register("udaf_lambda", sql(f"SELECT state, late_pct FROM ({STATE_STATS_SQL}) s"))
def udaf_lambda(spark, sf_dir):
    return R.delivery_by_state(RK.base(spark, sf_dir)[1], min_orders=0).select("state", "late_pct")


@register("fn_round_half_even", sql(f"""
SELECT state, round_even(avg_days, 1) AS avg_days, round_even(late_pct, 1) AS late_pct
FROM ({STATE_STATS_SQL}) s"""))
def fn_round_half_even(spark, sf_dir):
    s = R.delivery_by_state(RK.base(spark, sf_dir)[1], min_orders=0)
    return s.select("state", F.bround("avg_days", 1).alias("avg_days"),
                    F.bround("late_pct", 1).alias("late_pct"))


@register("agg_first", sql("SELECT * FROM purchase_frequency"))
def agg_first(spark, sf_dir):
    return RK.freq(spark, sf_dir)


@register("agg_value_counts", sql(
    "SELECT order_status, count(*) AS count FROM fct_orders GROUP BY order_status"))
def agg_value_counts(spark, sf_dir):
    return W(spark, sf_dir).fct_orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("count"))


@register("agg_quantile", sql("SELECT p, q FROM monetary_edges"))
def agg_quantile(spark, sf_dir):
    rfm = R.rfm_base(RK.base(spark, sf_dir)[1]).select("monetary")
    return exact_quantiles(write_and_reread(rfm, "monetary"), "monetary", R.QUINTILE_PROBS)


@register("agg_share_of_total", sql("SELECT segment, rev_pct, cus_pct FROM rfm_segment_summary"))
def agg_share_of_total(spark, sf_dir):
    return RK.rfm_segment_summary(spark, sf_dir).select("segment", "rev_pct", "cus_pct")


@register("sort_values", sql("SELECT * FROM rfm_segment_summary ORDER BY count DESC, segment"))
def sort_values(spark, sf_dir):
    return RK.rfm_segment_summary(spark, sf_dir)


@register("agg_null_profile", sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count "
    f"FROM raw_orders) x WHERE null_count > 0"
    for c in ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
              "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"])))
def agg_null_profile(spark, sf_dir):
    return Q.null_profile(W(spark, sf_dir).raw.orders)


# ----------------------------------------------------- windows, bins
@register("win_lag_gap", sql("SELECT customer_id, order_id, purchase_gap_days FROM order_with_gap"))
def win_lag_gap(spark, sf_dir):
    return MT.orders_with_gap(W(spark, sf_dir).fct_orders).select(
        "customer_id", "order_id", "purchase_gap_days")


@register("rank_first", sql("""
SELECT customer_id, frequency, row_number() OVER (ORDER BY frequency, customer_id) AS f_rank
FROM rfm_base"""))
def rank_first(spark, sf_dir):
    rfm = R.rfm_base(RK.base(spark, sf_dir)[1])
    return row_numbers(rfm.select("customer_id", "frequency"), ["frequency", "customer_id"],
                       out="f_rank")


@register("quantile_bins_value", sql("SELECT customer_id, r_score, m_score FROM rfm_scores"))
def quantile_bins_value(spark, sf_dir):
    return RK.rfm_scores(spark, sf_dir).select("customer_id", "r_score", "m_score")


@register("quantile_bins_rank", sql("SELECT customer_id, f_score FROM rfm_scores"))
def quantile_bins_rank(spark, sf_dir):
    return RK.rfm_scores(spark, sf_dir).select("customer_id", "f_score")


@register("udf_row_segment", sql("SELECT customer_id, r_score, f_score, segment FROM rfm_scores"))
def udf_row_segment(spark, sf_dir):
    return RK.rfm_scores(spark, sf_dir).select("customer_id", "r_score", "f_score", "segment")


@register("fixed_bins", sql("""
SELECT order_id, delivery_days,
       CASE WHEN delivery_days > 0 AND delivery_days <= 7 THEN '≤7 days'
            WHEN delivery_days > 7 AND delivery_days <= 14 THEN '8-14 days'
            WHEN delivery_days > 14 AND delivery_days <= 21 THEN '15-21 days'
            WHEN delivery_days > 21 AND delivery_days <= 999 THEN '>21 days' END
         AS delivery_bucket
FROM review_rows"""))
def fixed_bins_key(spark, sf_dir):
    r = RK.reviews(spark, sf_dir)
    return r.select("order_id", "delivery_days",
                    fixed_bins(F.col("delivery_days"), R.DELIVERY_BUCKET_EDGES,
                               R.DELIVERY_BUCKET_LABELS).alias("delivery_bucket"))


# ------------------------------------------------------ sort, top-k
@register("topk_sql", sql(
    "SELECT * FROM category_revenue ORDER BY revenue DESC, category_name_en LIMIT 10"))
def topk_sql(spark, sf_dir):
    return RK.top_categories(spark, sf_dir)


@register("topk_duplicates", sql("""
SELECT geolocation_zip_code_prefix, count(*) AS cnt FROM raw_geolocation
GROUP BY geolocation_zip_code_prefix HAVING count(*) > 1
ORDER BY cnt DESC, geolocation_zip_code_prefix LIMIT 5"""))
def topk_duplicates(spark, sf_dir):
    return Q.geolocation_duplicate_check(W(spark, sf_dir).raw.geolocation)


@register("limit_unordered", sql("""
SELECT order_id, count(*) AS cnt FROM raw_order_items GROUP BY order_id HAVING count(*) > 1
ORDER BY order_id LIMIT 10"""))
def limit_unordered(spark, sf_dir):
    i = W(spark, sf_dir).raw.order_items
    return Q.orders_duplicate_check(i)


@register("topk_nlargest", sql(
    "SELECT * FROM delivery_by_state ORDER BY avg_days DESC, state LIMIT 10"))
def topk_nlargest(spark, sf_dir):
    return RK.slowest_states(spark, sf_dir)


@register("sort_head", sql("""
SELECT order_count, count(*) AS customers FROM purchase_frequency
GROUP BY order_count ORDER BY order_count LIMIT 6"""))
def sort_head(spark, sf_dir):
    return RK.purchase_frequency_dist(spark, sf_dir)


# --------------------------------------------------- scalar functions
@register("fn_extract_day", sql("SELECT order_id, delivery_days FROM fct_orders"))
def fn_extract_day(spark, sf_dir):
    return W(spark, sf_dir).fct_orders.select("order_id", "delivery_days")


@register("fn_date_part_day", sql(
    "SELECT customer_id, days_since_last_order FROM mart_churn_labels"))
def fn_date_part_day(spark, sf_dir):
    return W(spark, sf_dir).mart_churn_labels.select("customer_id", "days_since_last_order")


@register("fn_timestamp_diff", sql("""
SELECT order_id,
       CAST(extract(day FROM delivered_to_customer_at - purchased_at) AS INTEGER) AS days,
       CAST(extract(hour FROM delivered_to_customer_at - purchased_at) AS INTEGER) AS hours,
       CAST(extract(minute FROM delivered_to_customer_at - purchased_at) AS INTEGER) AS minutes,
       CAST(floor(extract(second FROM delivered_to_customer_at - purchased_at)) AS INTEGER)
         AS seconds
FROM fct_orders WHERE delivered_to_customer_at IS NOT NULL"""))
def fn_timestamp_diff(spark, sf_dir):
    f = W(spark, sf_dir).fct_orders.filter(F.col("delivered_to_customer_at").isNotNull())
    parts = interval_parts(F.col("delivered_to_customer_at"), F.col("purchased_at"))
    return f.select("order_id", *[c.alias(n) for n, c in parts.items()])


@register("fn_timestamp_add", sql("""
SELECT max(purchased_at) AS ref_date, max(purchased_at) + INTERVAL 1 DAY AS report_ref_date
FROM order_customer_base"""))
def fn_timestamp_add(spark, sf_dir):
    b = RK.base(spark, sf_dir)[1]
    return b.agg(F.max("purchased_at").alias("ref_date"),
                 add_days(F.max("purchased_at"), 1).alias("report_ref_date"))


@register("fn_timedelta_days", sql("SELECT customer_id, recency FROM rfm_base"))
def fn_timedelta_days(spark, sf_dir):
    return R.rfm_base(RK.base(spark, sf_dir)[1]).select("customer_id", "recency")


@register("fn_month_text", sql(
    "SELECT order_id, strftime(purchased_at, '%Y-%m') AS month FROM fct_orders"))
def fn_month_text(spark, sf_dir):
    return W(spark, sf_dir).fct_orders.select("order_id",
                                              month_text(F.col("purchased_at")).alias("month"))
