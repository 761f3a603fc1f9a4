"""One warehouse = the raw tables of one source plus every model built on them.

``Warehouse`` wires the model functions together lazily. Nothing is computed
when an attribute is read; each attribute is a DataFrame plan, and a consumer
that needs only a few columns gets them pruned down to the raw scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .plans import marts, staging
from .sources.fixtures import RawTables


class Warehouse:
    MODELS = ("stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers",
              "stg_products", "stg_sellers", "dim_customers", "dim_sellers", "dim_products", "fct_orders",
              "mart_customer_features", "mart_churn_labels")

    def __init__(self, spark: SparkSession, sf_dir: str, raw: RawTables | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.raw = raw or RawTables(spark, sf_dir)

    # -- staging -------------------------------------------------------
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw.order_payments)

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw.order_reviews)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.sellers)

    # -- marts ---------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return marts.dim_sellers(self.stg_sellers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products, self.raw.product_category_translation)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.stg_orders, self.stg_order_items, self.stg_order_payments)

    @cached_property
    def mart_customer_features(self) -> DataFrame:
        return marts.mart_customer_features(self.fct_orders, self.dim_customers,
                                            self.stg_order_payments, self.stg_order_reviews)

    @cached_property
    def mart_churn_labels(self) -> DataFrame:
        return marts.mart_churn_labels(self.fct_orders)

    def model(self, name: str) -> DataFrame:
        """``ref(name)``: a model by name."""
        if name.startswith("raw."):
            return self.raw.get(name[4:])
        return getattr(self, name)
