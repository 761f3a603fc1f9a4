"""Keys for the named datasets: staging, dimensions, marts."""

from __future__ import annotations

from ..catalog import Warehouse
from ..oracle import model
from . import register


def _model_key(name: str):
    def run(spark, sf_dir):
        return getattr(Warehouse(spark, sf_dir), name)
    run.__name__ = name
    return run


for _name in ("stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
              "stg_customers", "stg_products", "stg_sellers", "dim_customers",
              "dim_products", "dim_sellers", "fct_orders", "mart_customer_features",
              "mart_churn_labels"):
    register(_name, model(_name))(_model_key(_name))
