"""Keys for the report tables."""

from __future__ import annotations

from ..catalog import Warehouse
from ..oracle import cte, sql
from ..plans import reports as R
from . import register


def base(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return w, R.order_customer_base(w.fct_orders, w.dim_customers)


cte("order_customer_base", """
SELECT f.order_id, f.customer_id, f.order_status, f.purchased_at, f.delivered_to_customer_at,
       f.estimated_delivery_at, f.total_order_value, f.delivery_days, c.state
FROM fct_orders f JOIN dim_customers c ON f.customer_id = c.customer_id
""")


@register("order_customer_base", sql("SELECT * FROM order_customer_base"))
def order_customer_base(spark, sf_dir):
    return base(spark, sf_dir)[1]


cte("rfm_base", """
SELECT customer_id,
       CAST(extract(day FROM (SELECT max(purchased_at) + INTERVAL 1 DAY FROM order_customer_base)
                              - max(purchased_at)) AS INTEGER) AS recency,
       count(order_id) AS frequency,
       CAST(coalesce(sum(total_order_value), 0) AS DECIMAL(38,2)) AS monetary
FROM order_customer_base GROUP BY customer_id
""")


def _quintile_edges_sql(name: str, col: str) -> None:
    # linear-interpolated quantiles at 0, .2, .4, .6, .8, 1 from row numbers
    cte(f"{name}_ranked", f"""
SELECT CAST({col} AS DOUBLE) AS v,
       row_number() OVER (ORDER BY CAST({col} AS DOUBLE), customer_id) AS rn,
       count(*) OVER () AS n
FROM rfm_base WHERE {col} IS NOT NULL
""")
    cte(f"{name}_edges", f"""
SELECT t.p, lo.v + (hi.v - lo.v) * t.frac AS q
FROM (SELECT p, floor((n - 1) * p) + 1 AS lo_rn, ceil((n - 1) * p) + 1 AS hi_rn,
             (n - 1) * p - floor((n - 1) * p) AS frac
      FROM (SELECT DISTINCT n FROM {name}_ranked) s,
           (SELECT unnest([0.0, 0.2, 0.4, 0.6, 0.8, 1.0]::DOUBLE[]) AS p) ps) t
JOIN {name}_ranked lo ON lo.rn = t.lo_rn
JOIN {name}_ranked hi ON hi.rn = t.hi_rn
""")


_quintile_edges_sql("recency", "recency")
_quintile_edges_sql("monetary", "monetary")


def _bin_sql(col: str, name: str, labels: list[int]) -> str:
    e = [f"(SELECT q FROM {name}_edges WHERE p = {p})" for p in (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)]
    x = f"CAST({col} AS DOUBLE)"
    parts = [f"WHEN {x} >= {e[0]} AND {x} <= {e[1]} THEN {labels[0]}"]
    parts += [f"WHEN {x} > {e[i]} AND {x} <= {e[i + 1]} THEN {labels[i]}" for i in range(1, 5)]
    return "CASE " + " ".join(parts) + " END"


cte("rfm_scores", f"""
SELECT customer_id, recency, frequency, monetary, r_score, f_score, m_score,
       CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
            WHEN f_score >= 3 THEN 'Loyal'
            WHEN r_score >= 4 THEN 'New'
            WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
            WHEN r_score <= 2 THEN 'Lost'
            ELSE 'Potential' END AS segment
FROM (SELECT customer_id, recency, frequency, monetary,
             {_bin_sql('recency', 'recency', [5, 4, 3, 2, 1])} AS r_score,
             CAST(greatest(1, floor((5 * (rn - 1) + n - 2) / (n - 1))) AS INTEGER) AS f_score,
             {_bin_sql('monetary', 'monetary', [1, 2, 3, 4, 5])} AS m_score
      FROM (SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS rn,
                   count(*) OVER () AS n FROM rfm_base) b) s
""")


@register("rfm_scores", sql("SELECT * FROM rfm_scores"))
def rfm_scores(spark, sf_dir):
    return R.rfm_scores(base(spark, sf_dir)[1])


cte("rfm_segment_summary", """
SELECT segment, count, total_rev,
       round_even(CAST(total_rev AS DOUBLE) / CAST(sum(total_rev) OVER () AS DOUBLE) * 100, 1)
         AS rev_pct,
       round_even(CAST(count AS DOUBLE) / CAST(sum(count) OVER () AS DOUBLE) * 100, 1) AS cus_pct
FROM (SELECT segment, count(customer_id) AS count,
             CAST(sum(monetary) AS DECIMAL(38,2)) AS total_rev
      FROM rfm_scores GROUP BY segment) g
""")


@register("rfm_segment_summary", sql("SELECT * FROM rfm_segment_summary"))
def rfm_segment_summary(spark, sf_dir):
    return R.rfm_segment_summary(rfm_scores(spark, sf_dir))


cte("delivered_orders", """
SELECT *, coalesce(delivered_to_customer_at > estimated_delivery_at, false) AS is_late
FROM order_customer_base WHERE delivery_days IS NOT NULL
""")


@register("delivery_kpis", sql("""
SELECT CAST(sum(CAST(is_late AS INTEGER)) AS DOUBLE) / count(is_late) * 100 AS late_pct,
       CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS avg_days,
       count(*) AS delivered_orders
FROM delivered_orders"""))
def delivery_kpis(spark, sf_dir):
    return R.delivery_kpis(base(spark, sf_dir)[1])


cte("delivery_by_state", """
SELECT state, CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS avg_days,
       CAST(sum(CAST(is_late AS INTEGER)) AS DOUBLE) / count(is_late) * 100 AS late_pct,
       count(order_id) AS order_count
FROM delivered_orders WHERE state IS NOT NULL GROUP BY state HAVING count(order_id) >= 100
""")


@register("delivery_by_state", sql("SELECT * FROM delivery_by_state"))
def delivery_by_state(spark, sf_dir):
    return R.delivery_by_state(base(spark, sf_dir)[1])


@register("slowest_states", sql(
    "SELECT * FROM delivery_by_state ORDER BY avg_days DESC, state LIMIT 10"))
def slowest_states(spark, sf_dir):
    return R.top_states(delivery_by_state(spark, sf_dir), "avg_days")


@register("latest_states", sql(
    "SELECT * FROM delivery_by_state ORDER BY late_pct DESC, state LIMIT 10"))
def latest_states(spark, sf_dir):
    return R.top_states(delivery_by_state(spark, sf_dir), "late_pct")


cte("review_rows", """
SELECT f.order_id, f.delivery_days, CAST(r.review_score AS INTEGER) AS review_score
FROM fct_orders f JOIN raw_order_reviews r ON f.order_id = r.order_id
WHERE f.delivery_days IS NOT NULL AND r.review_score IS NOT NULL
""")


def reviews(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return R.review_rows(w.fct_orders, w.raw.order_reviews)


@register("review_by_delivery_bucket", sql("""
SELECT bucket_order, delivery_bucket,
       CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_score,
       count(order_id) AS count
FROM (SELECT *,
             CASE WHEN delivery_days > 0 AND delivery_days <= 7 THEN 1
                  WHEN delivery_days > 7 AND delivery_days <= 14 THEN 2
                  WHEN delivery_days > 14 AND delivery_days <= 21 THEN 3
                  WHEN delivery_days > 21 AND delivery_days <= 999 THEN 4 END AS bucket_order,
             CASE WHEN delivery_days > 0 AND delivery_days <= 7 THEN '≤7 days'
                  WHEN delivery_days > 7 AND delivery_days <= 14 THEN '8-14 days'
                  WHEN delivery_days > 14 AND delivery_days <= 21 THEN '15-21 days'
                  WHEN delivery_days > 21 AND delivery_days <= 999 THEN '>21 days' END
               AS delivery_bucket
      FROM review_rows) b
WHERE delivery_bucket IS NOT NULL GROUP BY bucket_order, delivery_bucket"""))
def review_by_delivery_bucket(spark, sf_dir):
    return R.review_by_delivery_bucket(reviews(spark, sf_dir))


@register("review_overall_avg", sql("""
SELECT CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_score,
       count(*) AS reviews FROM review_rows"""))
def review_overall_avg(spark, sf_dir):
    return R.review_overall_avg(reviews(spark, sf_dir))


@register("monthly_revenue", sql("""
SELECT strftime(purchased_at, '%Y-%m') AS month,
       CAST(coalesce(sum(total_order_value), 0) AS DECIMAL(38,2)) AS revenue,
       count(order_id) AS orders
FROM order_customer_base GROUP BY 1"""))
def monthly_revenue(spark, sf_dir):
    return R.monthly_revenue(base(spark, sf_dir)[1])


cte("category_revenue", """
SELECT p.category_name_en, CAST(sum(oi.price + oi.freight_value) AS DECIMAL(38,2)) AS revenue,
       count(DISTINCT oi.order_id) AS orders
FROM stg_order_items oi JOIN dim_products p ON oi.product_id = p.product_id
WHERE p.category_name_en != 'uncategorized'
GROUP BY 1
""")


@register("top_categories", sql(
    "SELECT * FROM category_revenue ORDER BY revenue DESC, category_name_en LIMIT 10"))
def top_categories(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return R.top_categories(w.stg_order_items, w.dim_products)


cte("purchase_frequency", """
SELECT customer_id, count(order_id) AS order_count, min(state) AS state
FROM order_customer_base GROUP BY customer_id
""")


def freq(spark, sf_dir):
    return R.purchase_frequency(base(spark, sf_dir)[1])


@register("repeat_purchase_rate", sql("""
SELECT CAST(sum(CAST(order_count = 1 AS INTEGER)) AS DOUBLE) / count(*) * 100 AS one_time_pct,
       CAST(sum(CAST(order_count > 1 AS INTEGER)) AS DOUBLE) / count(*) * 100 AS repeat_pct,
       count(*) AS customers
FROM purchase_frequency"""))
def repeat_purchase_rate(spark, sf_dir):
    return R.repeat_purchase_rate(freq(spark, sf_dir))


@register("purchase_frequency_dist", sql("""
SELECT order_count, count(*) AS customers FROM purchase_frequency
GROUP BY order_count ORDER BY order_count LIMIT 6"""))
def purchase_frequency_dist(spark, sf_dir):
    return R.purchase_frequency_dist(freq(spark, sf_dir))
