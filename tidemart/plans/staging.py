"""Staging models: rename and cast only, one narrow projection per raw table.

Each function takes the raw (all-text) frame and returns a lazy frame; Spark
inlines them into every consumer the way views are inlined, so filters and
column pruning reach the raw scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TS = "timestamp_ntz"
MONEY = "decimal(10,2)"


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").cast(TS).alias("purchased_at"),
        F.col("order_approved_at").cast(TS).alias("approved_at"),
        F.col("order_delivered_carrier_date").cast(TS).alias("delivered_to_carrier_at"),
        F.col("order_delivered_customer_date").cast(TS).alias("delivered_to_customer_at"),
        F.col("order_estimated_delivery_date").cast(TS).alias("estimated_delivery_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast(TS).alias("shipping_limit_at"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast(MONEY).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        F.col("review_creation_date").cast(TS).alias("review_creation_date"),
        F.col("review_answer_timestamp").cast(TS).alias("review_answer_timestamp"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        F.col("product_category_name").alias("category_name"),
        F.col("product_name_lenght").cast("int").alias("name_length"),
        F.col("product_description_lenght").cast("int").alias("description_length"),
        F.col("product_photos_qty").cast("int").alias("photos_qty"),
        F.col("product_weight_g").cast(MONEY).alias("weight_g"),
        F.col("product_length_cm").cast(MONEY).alias("length_cm"),
        F.col("product_height_cm").cast(MONEY).alias("height_cm"),
        F.col("product_width_cm").cast(MONEY).alias("width_cm"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )


STAGING = {
    "stg_orders": ("orders", stg_orders),
    "stg_order_items": ("order_items", stg_order_items),
    "stg_order_payments": ("order_payments", stg_order_payments),
    "stg_order_reviews": ("order_reviews", stg_order_reviews),
    "stg_customers": ("customers", stg_customers),
    "stg_products": ("products", stg_products),
    "stg_sellers": ("sellers", stg_sellers),
}
