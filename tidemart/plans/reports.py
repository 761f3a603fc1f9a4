"""Report tables: the data behind the analysis charts.

Each report is a DataFrame plan over the marts. pandas semantics the numbers
depend on are kept explicitly: an all-NULL sum is 0 in a report (NULL in a
mart), a comparison with a missing timestamp is false, group-by drops NULL
keys, rounding is half-even, quantile bins are right-closed with the lowest
edge included, and ``rank(method='first')`` breaks ties by the key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import edge_bins, fixed_bins, rank_quintile
from ..functions.temporal import add_days, elapsed_days, month_text
from ..operators.positions import write_and_reread
from ..operators.scale import exact_quantiles, row_numbers
from .marts import MONEY_SUM, mean

# Delivery-time buckets (days, right-closed) and their labels.
DELIVERY_BUCKET_EDGES = [0, 7, 14, 21, 999]
DELIVERY_BUCKET_LABELS = ["≤7 days", "8-14 days", "15-21 days", ">21 days"]
# RFM segment names, rules applied in this order (At Risk can
# never match: any f >= 3 has already been taken by Loyal).
SEGMENTS = ("Champions", "Loyal", "New", "At Risk", "Lost", "Potential")
QUINTILE_PROBS = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
MIN_STATE_ORDERS = 100
TOP_K = 10


def order_customer_base(fct: DataFrame, dim_cust: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Orders with the customer's state (inner join, 9 columns) and the customer
    columns ``carry``, e.g. ``customer_unique_id`` to score real buyers by it."""
    c = dim_cust.select("customer_id", "state", *carry)
    return fct.join(c, "customer_id").select(
        "order_id", "customer_id", "order_status", "purchased_at",
        "delivered_to_customer_at", "estimated_delivery_at", "total_order_value",
        "delivery_days", "state", *carry)


def is_late(delivered: Column, estimated: Column) -> Column:
    """Late = delivered after the estimate; a missing timestamp is not late."""
    return F.coalesce(delivered > estimated, F.lit(False))


def pct(cond: Column) -> Column:
    """Mean of a boolean times 100."""
    return F.sum(cond.cast("int")).cast("double") / F.count(cond) * 100


# ------------------------------------------------------------------ RFM
def rfm_base(base: DataFrame, key: str = "customer_id") -> DataFrame:
    """Recency (days to max purchase + 1 day), frequency and monetary per key."""
    ref = add_days(base.agg(F.max("purchased_at")).scalar(), 1)
    return base.groupBy(key).agg(
        elapsed_days(ref, F.max("purchased_at")).alias("recency"),
        F.count("order_id").alias("frequency"),
        F.coalesce(F.sum("total_order_value"), F.lit(0)).cast(MONEY_SUM).alias("monetary"),
    )


def quintile_edges(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Quintile edges (p = 0, .2, ..., 1) of several columns, selected together:
    the columns are stacked as (metric, value)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("r")).select("r.*")
    return exact_quantiles(long, "value", QUINTILE_PROBS, group_cols=["metric"])


def value_quintile(edges: dict[tuple[str, float], float], col: str, reverse: bool = False) -> Column:
    """Quintile bin of a value (pandas ``qcut(x, 5)``), 5..1 when reversed."""
    edges = [F.lit(edges.get((col, p))).cast("double") for p in QUINTILE_PROBS]
    labels = [5, 4, 3, 2, 1] if reverse else [1, 2, 3, 4, 5]
    return edge_bins(F.col(col).cast("double"), edges, labels)


def segment(r: Column, f: Column) -> Column:
    return (F.when((r >= 4) & (f >= 4), SEGMENTS[0])
             .when(f >= 3, SEGMENTS[1])
             .when(r >= 4, SEGMENTS[2])
             .when((r <= 2) & (f >= 3), SEGMENTS[3])
             .when(r <= 2, SEGMENTS[4])
             .otherwise(SEGMENTS[5]))


def rfm_scores(base: DataFrame, key: str = "customer_id") -> DataFrame:
    """Per key: recency, frequency, monetary, r/f/m scores and segment."""
    # one row per customer, read by the passes below: written once
    rfm = write_and_reread(rfm_base(base, key), "rfm")
    edges = {(r["metric"], r["p"]): r["q"]  # twelve rows
             for r in quintile_edges(rfm, ["recency", "monetary"], key).collect()}
    r_score = value_quintile(edges, "recency", reverse=True)
    m_score = value_quintile(edges, "monetary")
    # rank(method='first') on frequency: ties in key order
    ranked = row_numbers(rfm, ["frequency", key], out="_frank")
    n = F.lit(rfm.count())
    scored = ranked.select(
        key, "recency", "frequency", "monetary",
        r_score.alias("r_score"),
        rank_quintile(F.col("_frank"), n).alias("f_score"),
        m_score.alias("m_score"),
    )
    return scored.withColumn("segment", segment(F.col("r_score"), F.col("f_score")))


def rfm_segment_summary(scores: DataFrame) -> DataFrame:
    """Customers and revenue per segment with half-even rounded shares."""
    g = scores.groupBy("segment").agg(F.count("customer_id").alias("count"),
                                      F.sum("monetary").cast(MONEY_SUM).alias("total_rev"))
    everything = Window.partitionBy()  # the grouped frame has at most 6 rows
    return g.select(
        "segment", "count", "total_rev",
        F.bround(F.col("total_rev").cast("double")
                 / F.sum("total_rev").over(everything).cast("double") * 100, 1).alias("rev_pct"),
        F.bround(F.col("count").cast("double")
                 / F.sum("count").over(everything).cast("double") * 100, 1).alias("cus_pct"),
    ).orderBy(F.desc("count"), "segment")


# ------------------------------------------------------------- delivery
def delivered_orders(base: DataFrame) -> DataFrame:
    return base.filter(F.col("delivery_days").isNotNull()).withColumn(
        "is_late", is_late(F.col("delivered_to_customer_at"), F.col("estimated_delivery_at")))


def delivery_kpis(base: DataFrame) -> DataFrame:
    d = delivered_orders(base)
    return d.agg(pct(F.col("is_late")).alias("late_pct"),
                 mean(F.col("delivery_days")).alias("avg_days"),
                 F.count(F.lit(1)).alias("delivered_orders"))


def delivery_by_state(base: DataFrame, min_orders: int = MIN_STATE_ORDERS) -> DataFrame:
    d = delivered_orders(base).filter(F.col("state").isNotNull())
    g = d.groupBy("state").agg(mean(F.col("delivery_days")).alias("avg_days"),
                               pct(F.col("is_late")).alias("late_pct"),
                               F.count("order_id").alias("order_count"))
    return g.filter(F.col("order_count") >= min_orders)


def top_states(stats: DataFrame, by: str, k: int = TOP_K) -> DataFrame:
    """``nlargest(k, by)``: ties keep the first row, i.e. the smaller state."""
    return stats.orderBy(F.desc(by), F.asc("state")).limit(k)


# ------------------------------------------------------------- reviews
def review_rows(fct: DataFrame, raw_reviews: DataFrame) -> DataFrame:
    """Delivered orders with a review: order_id, delivery_days, review_score."""
    r = raw_reviews.select("order_id", F.col("review_score").cast("int").alias("review_score"))
    return (fct.select("order_id", "delivery_days").join(r, "order_id")
               .filter(F.col("delivery_days").isNotNull() & F.col("review_score").isNotNull()))


def review_by_delivery_bucket(rows: DataFrame) -> DataFrame:
    b = rows.withColumn("delivery_bucket",
                        fixed_bins(F.col("delivery_days"), DELIVERY_BUCKET_EDGES,
                                   DELIVERY_BUCKET_LABELS))
    order = fixed_bins(F.col("delivery_days"), DELIVERY_BUCKET_EDGES,
                       list(range(1, len(DELIVERY_BUCKET_LABELS) + 1)))
    b = b.withColumn("bucket_order", order).filter(F.col("delivery_bucket").isNotNull())
    return b.groupBy("bucket_order", "delivery_bucket").agg(
        mean(F.col("review_score")).alias("avg_score"),
        F.count("order_id").alias("count"))


def review_overall_avg(rows: DataFrame) -> DataFrame:
    return rows.agg(mean(F.col("review_score")).alias("avg_score"),
                    F.count(F.lit(1)).alias("reviews"))


# ------------------------------------------------------------- revenue
def monthly_revenue(base: DataFrame) -> DataFrame:
    return base.groupBy(month_text(F.col("purchased_at")).alias("month")).agg(
        F.coalesce(F.sum("total_order_value"), F.lit(0)).cast(MONEY_SUM).alias("revenue"),
        F.count("order_id").alias("orders"))


def category_revenue(stg_items: DataFrame, dim_prod: DataFrame) -> DataFrame:
    p = dim_prod.select("product_id", "category_name_en")
    j = stg_items.join(p, "product_id").filter(F.col("category_name_en") != "uncategorized")
    return j.groupBy("category_name_en").agg(
        F.sum(F.col("price") + F.col("freight_value")).cast(MONEY_SUM).alias("revenue"),
        F.count_distinct("order_id").alias("orders"))


def top_categories(stg_items: DataFrame, dim_prod: DataFrame, k: int = TOP_K) -> DataFrame:
    return category_revenue(stg_items, dim_prod) \
        .orderBy(F.desc("revenue"), F.asc("category_name_en")).limit(k)


# ------------------------------------------------------------- repeat
def purchase_frequency(base: DataFrame, key: str = "customer_id") -> DataFrame:
    """Orders per key and its state (state is fixed per customer: min = first)."""
    return base.groupBy(key).agg(F.count("order_id").alias("order_count"),
                                 F.min("state").alias("state"))


def repeat_purchase_rate(freq: DataFrame) -> DataFrame:
    return freq.agg(pct(F.col("order_count") == 1).alias("one_time_pct"),
                    pct(F.col("order_count") > 1).alias("repeat_pct"),
                    F.count(F.lit(1)).alias("customers"))


def purchase_frequency_dist(freq: DataFrame, head: int = 6) -> DataFrame:
    return (freq.groupBy("order_count").agg(F.count(F.lit(1)).alias("customers"))
                .orderBy("order_count").limit(head))
