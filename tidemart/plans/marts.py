"""Mart models: dimensions, the order fact, the customer feature store, labels.

Plan notes (checked with ``explain``):
* ``fct_orders`` aggregates items and payments per order *before* the two left
  joins (map-side partial aggregation, then one shuffle each on ``order_id``);
  the aggregates come out hash-partitioned on ``order_id``, so the joins add
  only the orders-side exchange.
* The reference date is an uncorrelated scalar subquery, run once.
* The purchase-gap lag runs on ranges of (customer, time, order), one shuffle,
  so a customer holding a large share of orders is split across tasks.
* Per-customer aggregates use partial (map-side) aggregation, so a hot
  customer is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import elapsed_days
from ..operators.carry import lag_with_carry

# Defaults of the feature mart when a customer has no payments or
# no reviews, the churn horizon and the untranslated-category label.
DEFAULT_INSTALLMENTS = 1
DEFAULT_CREDIT_CARD_RATE = 0
DEFAULT_REVIEW_SCORE = 3
DEFAULT_BAD_REVIEW_RATE = 0
CHURN_DAYS = 90
UNCATEGORIZED = "uncategorized"
MONEY_SUM = "decimal(38,2)"


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select("customer_id", "customer_unique_id", "zip_code", "city", "state")


def dim_sellers(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select("seller_id", "zip_code", "city", "state")


def dim_products(stg_products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category, 'uncategorized' when missing."""
    t = translation.select(F.col("product_category_name").alias("_cat"),
                           "product_category_name_english")
    j = stg_products.join(t, F.col("category_name") == F.col("_cat"), "left")
    return j.select(
        "product_id",
        F.coalesce(F.col("product_category_name_english"), F.lit(UNCATEGORIZED))
         .alias("category_name_en"),
        F.col("category_name").alias("category_name_pt"),
        "weight_g", "length_cm", "height_cm", "width_cm",
    )


def payment_totals(stg_payments: DataFrame) -> DataFrame:
    """Per order: payment sum and most installments."""
    return stg_payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(MONEY_SUM).alias("total_payment_value"),
        F.max("payment_installments").alias("max_installments"),
    )


def item_totals(stg_items: DataFrame) -> DataFrame:
    """Per order: item count, price, freight and price + freight."""
    return stg_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        F.sum("price").cast(MONEY_SUM).alias("total_price"),
        F.sum("freight_value").cast(MONEY_SUM).alias("total_freight_value"),
        F.sum(F.col("price") + F.col("freight_value")).cast(MONEY_SUM).alias("total_order_value"),
    )


def delivery_days(delivered: Column, purchased: Column) -> Column:
    return F.when(delivered.isNotNull(), elapsed_days(delivered, purchased))


def fct_orders(stg_orders: DataFrame, stg_items: DataFrame, stg_payments: DataFrame) -> DataFrame:
    """One row per order; orders without items or payments keep NULL metrics."""
    o = stg_orders.alias("o")
    j = (o.join(item_totals(stg_items).alias("oa"), "order_id", "left")
          .join(payment_totals(stg_payments).alias("p"), "order_id", "left"))
    return j.select(
        "order_id", "customer_id", "order_status", "purchased_at", "approved_at",
        "delivered_to_carrier_at", "delivered_to_customer_at", "estimated_delivery_at",
        "item_count", "total_price", "total_freight_value", "total_order_value",
        "total_payment_value", "max_installments",
        delivery_days(F.col("delivered_to_customer_at"), F.col("purchased_at"))
         .alias("delivery_days"),
    )


def ref_date_frame(orders: DataFrame) -> DataFrame:
    """The reference date: latest purchase over all orders (all statuses).

    ``orders`` is ``fct_orders`` or ``stg_orders``: the fact keeps exactly one
    row per staged order, so both give the same maximum.
    """
    return orders.agg(F.max("purchased_at").alias("ref_date"))


def ref_date(orders: DataFrame) -> Column:
    """Reference date as an uncorrelated scalar subquery (computed once)."""
    return ref_date_frame(orders).scalar()


def orders_with_gap(fct: DataFrame) -> DataFrame:
    """Delivered orders with whole days since the customer's previous purchase.
    A customer with any share of the orders is split (``operators.carry``); a
    NULL customer is a customer, as in a plain window."""
    d = fct.filter(F.col("order_status") == "delivered").select(
        "customer_id", "order_id", "purchased_at", "delivered_to_customer_at",
        "estimated_delivery_at", "total_order_value", "delivery_days", "item_count")
    g = lag_with_carry(d, ["customer_id"], ["purchased_at", "order_id"], "purchased_at", "_prev")
    return g.withColumn("purchase_gap_days", elapsed_days(F.col("purchased_at"), F.col("_prev"))).drop("_prev")


def mean(c: Column) -> Column:
    """Mean as exact sum / count in double (engine-independent last digit)."""
    return F.sum(c).cast("double") / F.count(c)


def rate(cond: Column) -> Column:
    """share of rows where ``cond`` holds; NULL comparison counts as false."""
    return (F.sum(F.when(cond, 1).otherwise(0)).cast("double")
            / F.nullif(F.count(F.lit(1)), F.lit(0)))


def order_features(gap: DataFrame, ref: Column) -> DataFrame:
    return gap.groupBy("customer_id").agg(
        elapsed_days(ref, F.max("purchased_at")).alias("recency_days"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("total_order_value").cast(MONEY_SUM).alias("monetary"),
        mean(F.col("total_order_value")).alias("avg_order_value"),
        mean(F.col("delivery_days")).alias("avg_delivery_days"),
        F.max("delivery_days").alias("max_delivery_days"),
        rate(F.col("delivered_to_customer_at") > F.col("estimated_delivery_at"))
         .alias("late_delivery_rate"),
        mean(F.col("item_count")).alias("avg_items_per_order"),
        mean(F.col("purchase_gap_days")).alias("avg_purchase_gap_days"),
    )


def payment_features(fct: DataFrame, stg_payments: DataFrame) -> DataFrame:
    """Per customer over payment rows (fan-out: one order, many payments)."""
    j = fct.select("order_id", "customer_id").join(stg_payments, "order_id")
    return j.groupBy("customer_id").agg(
        mean(F.col("payment_installments")).alias("avg_installments"),
        rate(F.col("payment_type") == "credit_card").alias("credit_card_rate"),
    )


def review_features(fct: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    """Per customer over review rows (fan-out: one order, many reviews)."""
    j = fct.select("order_id", "customer_id").join(stg_reviews, "order_id")
    return j.groupBy("customer_id").agg(
        mean(F.col("review_score")).alias("avg_review_score"),
        F.min("review_score").alias("min_review_score"),
        rate(F.col("review_score") <= 2).alias("bad_review_rate"),
    )


def mart_customer_features(fct: DataFrame, dim_cust: DataFrame, stg_payments: DataFrame,
                           stg_reviews: DataFrame) -> DataFrame:
    """One row per customer with at least one delivered order (16 columns)."""
    ref = ref_date(fct)
    f = order_features(orders_with_gap(fct), ref)
    p = payment_features(fct, stg_payments)
    r = review_features(fct, stg_reviews)
    c = dim_cust.select("customer_id", F.col("state").alias("customer_state"))
    j = c.join(f, "customer_id").join(p, "customer_id", "left").join(r, "customer_id", "left")
    return j.select(
        "customer_id", "customer_state", "recency_days", "frequency", "monetary",
        "avg_order_value", "avg_delivery_days", "max_delivery_days", "late_delivery_rate",
        "avg_items_per_order", "avg_purchase_gap_days",
        F.coalesce("avg_installments", F.lit(DEFAULT_INSTALLMENTS).cast("double"))
         .alias("avg_installments"),
        F.coalesce("credit_card_rate", F.lit(DEFAULT_CREDIT_CARD_RATE).cast("double"))
         .alias("credit_card_rate"),
        F.coalesce("avg_review_score", F.lit(DEFAULT_REVIEW_SCORE).cast("double"))
         .alias("avg_review_score"),
        F.coalesce("min_review_score", F.lit(DEFAULT_REVIEW_SCORE)).alias("min_review_score"),
        F.coalesce("bad_review_rate", F.lit(DEFAULT_BAD_REVIEW_RATE).cast("double"))
         .alias("bad_review_rate"),
    )


def mart_churn_labels(fct: DataFrame, horizon_days: int = CHURN_DAYS) -> DataFrame:
    """Last delivered purchase per customer and the churn flag (> horizon days)."""
    ref = ref_date(fct)
    last = (fct.filter(F.col("order_status") == "delivered")
               .groupBy("customer_id")
               .agg(F.max("purchased_at").alias("last_order_date"),
                    F.count_distinct("order_id").alias("total_orders")))
    days = elapsed_days(ref, F.col("last_order_date"))
    return last.select(
        "customer_id", "last_order_date", "total_orders",
        ref.alias("ref_date"),
        days.alias("days_since_last_order"),
        F.when(days > horizon_days, 1).otherwise(0).alias("is_churned"),
    )
