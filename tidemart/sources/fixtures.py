"""Driver tables -> the nine raw, all-text retail tables.

The engine's input is nine raw tables whose every column is text (orders,
order_items, order_payments, order_reviews, customers, products, sellers,
geolocation, product_category_translation). The test bed ships TPC-H-like
Parquet tables instead, so this module derives the raw tables from them with
fixed arithmetic rules (see FIXTURES.md §2). Every rule is a column expression,
so the derivation is one narrow pass per table (plus a broadcast of the 25-row
nation table) and grows linearly with the input.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

TS_TEXT = "yyyy-MM-dd HH:mm:ss"

# Payment type by return flag (FIXTURES.md §2).
PAYMENT_TYPE_BY_FLAG = {"A": "credit_card", "N": "boleto", "R": "voucher"}
# Fixed value: the one brand left without an English translation.
UNTRANSLATED_CATEGORY = "brand#7"


def _ts_text(c: Column) -> Column:
    return F.date_format(c, TS_TEXT)


def _dec_text(c: Column) -> Column:
    return c.cast("decimal(10,2)").cast("string")


def _zip(key: Column) -> Column:
    return F.lpad((key % 1000).cast("string"), 5, "0")


def _secs(n: Column) -> Column:
    return F.make_dt_interval(secs=n)


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


class DriverTables:
    """Lazy readers for the driver's Parquet tables in one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)


class RawTables:
    """The nine raw tables, every column text, derived from the driver tables."""

    NAMES = ("orders", "order_items", "order_payments", "order_reviews",
             "customers", "products", "sellers", "geolocation",
             "product_category_translation")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.src = DriverTables(spark, sf_dir)

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def orders(self) -> DataFrame:
        o = self.src.orders
        k = F.col("o_orderkey")
        delivered = F.col("order_status") == "delivered"
        purchase = F.col("o_orderdate") + _secs((k * 7919) % 86400)
        return (
            o.select(
                k,
                F.col("o_custkey"),
                F.col("o_orderdate"),
                F.when(F.col("o_orderstatus") == "O", "shipped")
                 .otherwise("delivered").alias("order_status"),
            )
            .withColumn("pt", purchase)
            .select(
                k.cast("string").alias("order_id"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                "order_status",
                _ts_text(F.col("pt")).alias("order_purchase_timestamp"),
                F.when(k % 97 != 0, _ts_text(F.col("pt") + F.expr("INTERVAL 1 HOUR")))
                 .alias("order_approved_at"),
                F.when(delivered & (k % 61 != 0),
                       _ts_text(F.col("pt") + F.expr("INTERVAL 1 DAY")))
                 .alias("order_delivered_carrier_date"),
                F.when(delivered & (k % 50 != 0),
                       _ts_text(F.col("pt") + _days((k * 31) % 40) + _secs((k * 13) % 86400)))
                 .alias("order_delivered_customer_date"),
                _ts_text(F.col("o_orderdate") + _days(10 + k % 20))
                 .alias("order_estimated_delivery_date"),
            )
        )

    @cached_property
    def order_items(self) -> DataFrame:
        li = self.src.lineitem
        return li.select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("string").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            _ts_text(F.col("l_shipdate")).alias("shipping_limit_date"),
            _dec_text(F.col("l_extendedprice")).alias("price"),
            _dec_text(F.col("l_quantity")).alias("freight_value"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        li = self.src.lineitem.filter(F.col("l_linestatus") == "F")
        ptype = F.when(F.col("l_returnflag") == "A", PAYMENT_TYPE_BY_FLAG["A"]) \
                 .when(F.col("l_returnflag") == "N", PAYMENT_TYPE_BY_FLAG["N"]) \
                 .when(F.col("l_returnflag") == "R", PAYMENT_TYPE_BY_FLAG["R"])
        return li.select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("string").alias("payment_sequential"),
            ptype.alias("payment_type"),
            (1 + F.col("l_quantity").cast("bigint") % 10).cast("string")
             .alias("payment_installments"),
            _dec_text(F.col("l_extendedprice")).alias("payment_value"),
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        li = self.src.lineitem.filter(F.col("l_linenumber") == 1)
        return li.select(
            F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("-"),
                     F.col("l_partkey").cast("string"), F.lit("-"),
                     F.col("l_suppkey").cast("string")).alias("review_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            (1 + F.col("l_quantity").cast("bigint") % 5).cast("string").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.lit(None).cast("string").alias("review_comment_message"),
            _ts_text(F.col("l_shipdate")).alias("review_creation_date"),
            _ts_text(F.col("l_shipdate")).alias("review_answer_timestamp"),
        )

    def _with_nation(self, df: DataFrame, key: str) -> DataFrame:
        # nation is a fixed 25-row dimension: a broadcast of bounded size
        n = self.src.nation.select(F.col("n_nationkey").alias(key), "n_name")
        return df.join(F.broadcast(n), key, "left")

    @cached_property
    def customers(self) -> DataFrame:
        c = self._with_nation(self.src.customer, "c_nationkey")
        return c.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_custkey").cast("string").alias("customer_unique_id"),
            _zip(F.col("c_custkey")).alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        p = self.src.part
        return p.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_partkey") % 53 != 0, F.lower("p_brand"))
             .alias("product_category_name"),
            F.length("p_name").cast("string").alias("product_name_lenght"),
            (F.col("p_size") * 10).cast("string").alias("product_description_lenght"),
            (F.col("p_size") % 6).cast("string").alias("product_photos_qty"),
            _dec_text(F.col("p_retailprice")).alias("product_weight_g"),
            F.col("p_size").cast("string").alias("product_length_cm"),
            (F.col("p_size") + 1).cast("string").alias("product_height_cm"),
            (F.col("p_size") + 2).cast("string").alias("product_width_cm"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        s = self._with_nation(self.src.supplier, "s_nationkey")
        return s.select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            _zip(F.col("s_suppkey")).alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        c = self._with_nation(self.src.customer, "c_nationkey")
        return c.select(
            _zip(F.col("c_custkey")).alias("geolocation_zip_code_prefix"),
            F.col("c_acctbal").cast("string").alias("geolocation_lat"),
            F.col("c_nationkey").cast("string").alias("geolocation_lng"),
            F.col("c_mktsegment").alias("geolocation_city"),
            F.col("n_name").alias("geolocation_state"),
        )

    @cached_property
    def product_category_translation(self) -> DataFrame:
        p = self.src.part.select(F.lower("p_brand").alias("product_category_name"),
                                 F.upper("p_brand").alias("product_category_name_english"))
        return (p.filter(F.col("product_category_name") != UNTRANSLATED_CATEGORY)
                 .distinct())
