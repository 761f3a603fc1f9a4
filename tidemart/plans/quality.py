"""Data-quality checks as DataFrames: one row per check result.

All declared column tests (not_null, unique) of a table come from one pass: the
table is grouped once by its unique key (partial aggregation first, so a
repeated key is pre-counted before the shuffle), each group carrying the NULL
counts of the other columns. The suite unions the check frames; nothing is
collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The declared column tests (model, column).
NOT_NULL_TESTS = [
    ("stg_orders", "order_id"),
    ("stg_customers", "customer_id"),
    ("stg_order_items", "order_id"),
    ("stg_order_items", "product_id"),
    ("stg_order_payments", "order_id"),
    ("stg_order_payments", "payment_value"),
    ("stg_order_reviews", "review_id"),
    ("stg_order_reviews", "order_id"),
    ("stg_order_reviews", "review_score"),
    ("fct_orders", "order_id"),
    ("dim_customers", "customer_id"),
    ("dim_products", "product_id"),
]
UNIQUE_TESTS = [
    ("stg_orders", "order_id"),
    ("stg_customers", "customer_id"),
    ("fct_orders", "order_id"),
    ("dim_customers", "customer_id"),
    ("dim_products", "product_id"),
]
ORDER_NULL_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]


def _result(check: str, model: str, column: str, failures) -> DataFrame:
    return failures.select(F.lit(check).alias("test"), F.lit(model).alias("model"),
                           F.lit(column).alias("column_name"),
                           F.col("failures").cast("long").alias("failures"))


def _one_pass(df: DataFrame, unique: str | None, cols: list[str]) -> DataFrame:
    """One row: ``dup`` (non-null values of ``unique`` found twice or more),
    ``rows`` and ``null_<i>`` for each of ``cols``."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(cols)]
    if unique is None:
        return df.agg(F.lit(None).cast("long").alias("dup"), F.count(F.lit(1)).alias("rows"), *nulls)
    g = df.groupBy(F.col(unique).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *[
        n for n, c in zip(nulls, cols) if c != unique])
    return g.agg(
        F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull()).alias("dup"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n")) if c == unique
                           else F.col(f"null_{i}")), F.lit(0)).alias(f"null_{i}")
          for i, c in enumerate(cols)])


def declared_results(models: dict[str, DataFrame], not_null=NOT_NULL_TESTS,
                     unique=UNIQUE_TESTS) -> DataFrame:
    """(test, model, column_name, failures) of all declared tests, one grouped
    pass per model (and one more for each further unique column)."""
    parts = []
    for m in dict.fromkeys([m for m, _ in not_null] + [m for m, _ in unique]):
        cols = [c for x, c in not_null if x == m]
        keys = [c for x, c in unique if x == m] or [None]
        for k, key in enumerate(keys):
            here = cols if k == 0 else []
            rows = [("not_null", c, F.col(f"null_{i}")) for i, c in enumerate(here)]
            rows += [("unique", key, F.col("dup"))] if key else []
            parts.append(_one_pass(models[m], key, here).select(F.explode(F.array(*[
                F.struct(F.lit(t).alias("test"), F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                         v.cast("long").alias("failures")) for t, c, v in rows])).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def not_null_results(models: dict[str, DataFrame], tests=NOT_NULL_TESTS) -> DataFrame:
    return declared_results(models, tests, [])


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-null key values that occur more than once, with their count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1))


def unique_results(models: dict[str, DataFrame], tests=UNIQUE_TESTS) -> DataFrame:
    return declared_results(models, [], tests)


def row_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """Every raw table with its row count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in sorted(raw.items())]
    return reduce(DataFrame.unionByName, parts)


def orders_null_check(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("order_id").alias("non_null_order_id"),
        F.count("customer_id").alias("non_null_customer_id"),
        F.count("order_status").alias("non_null_status"),
        F.count("order_purchase_timestamp").alias("non_null_purchase_ts"))


def orders_duplicate_check(raw_orders: DataFrame, limit: int = 10) -> DataFrame:
    """Repeated order ids (first ``limit`` by id; the source query has no order)."""
    d = raw_orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("cnt")) \
                  .filter(F.col("cnt") > 1)
    return d.orderBy("order_id").limit(limit)


def geolocation_duplicate_check(raw_geo: DataFrame, limit: int = 5) -> DataFrame:
    """Most repeated zip prefixes (ties by prefix)."""
    col = "geolocation_zip_code_prefix"
    d = raw_geo.groupBy(col).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
    return d.orderBy(F.desc("cnt"), F.asc(col)).limit(limit)


def orphan_order_items(raw_items: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Items whose order does not exist (anti join), counted."""
    o = raw_orders.select("order_id")
    return raw_items.join(o, "order_id", "left_anti").agg(
        F.count(F.lit(1)).alias("orphan_count"))


def suite(models: dict[str, DataFrame], raw: dict[str, DataFrame]) -> DataFrame:
    """Every check as (test, model, column_name, failures, status).

    Declared tests fail on any failing row; of the ad-hoc checks, duplicate
    orders, orphan items, NULLs in the four order columns and empty raw tables
    fail, and repeated zip prefixes only warn (they are expected there).
    """
    declared = declared_results(models).withColumn("severity", F.lit("error"))
    o = raw["orders"]
    # one grouped pass over raw orders: NULLs, repeated ids (a NULL id too)
    per_id = o.groupBy("order_id").agg(F.count(F.lit(1)).alias("cnt"), *[
        F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in ORDER_NULL_COLUMNS])
    of_orders = per_id.agg(
        sum((F.coalesce(F.sum(f"_{c}"), F.lit(0)) for c in ORDER_NULL_COLUMNS), F.lit(0)).alias("nulls"),
        F.count_if(F.col("cnt") > 1).alias("dups"))
    geo = duplicate_keys(raw["geolocation"], "geolocation_zip_code_prefix") \
        .agg(F.count(F.lit(1)).alias("failures"))
    orphans = orphan_order_items(raw["order_items"], o).select(
        F.col("orphan_count").alias("failures"))
    empty = row_counts(raw).agg(F.count_if(F.col("row_count") == 0).alias("failures"))
    adhoc = reduce(DataFrame.unionByName, [
        _result("row_counts", "raw", "*", empty).withColumn("severity", F.lit("error")),
        of_orders.select(F.explode(F.array(
            F.struct(F.lit("orders_null_check").alias("test"), F.lit("raw.orders").alias("model"),
                     F.lit(",".join(ORDER_NULL_COLUMNS)).alias("column_name"),
                     F.col("nulls").cast("long").alias("failures")),
            F.struct(F.lit("orders_duplicate_check").alias("test"), F.lit("raw.orders").alias("model"),
                     F.lit("order_id").alias("column_name"),
                     F.col("dups").cast("long").alias("failures")))).alias("r")).select("r.*")
            .withColumn("severity", F.lit("error")),
        _result("geolocation_duplicate_check", "raw.geolocation",
                "geolocation_zip_code_prefix", geo).withColumn("severity", F.lit("warn")),
        _result("orphan_order_items", "raw.order_items", "order_id", orphans)
            .withColumn("severity", F.lit("error")),
    ])
    allr = declared.unionByName(adhoc)
    return allr.withColumn(
        "status", F.when(F.col("failures") == 0, "pass")
                   .when(F.col("severity") == "warn", "warn").otherwise("fail")).drop("severity")


SAMPLE_ROWS = 2


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column: rows, columns, position, NULL count (one scan
    each) and the values of the first ``SAMPLE_ROWS`` rows in the order of all
    columns (NULL last, shown empty), joined by ``|``."""
    parts = []
    for name, df in sorted(tables.items()):
        cols = df.columns
        agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}")
                       for i, c in enumerate(cols)])
        shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols]
        order = F.struct(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in cols])
        # every task keeps its first rows by the plain columns; only those few are made into structs
        first = (df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in cols]).limit(SAMPLE_ROWS)
                 .agg(F.sort_array(F.collect_list(F.struct(order.alias("_o"), F.array(*shown).alias("_v")))).alias("_s"))
                 .select(F.col("_s._v").alias("_first")))
        rows = agg.select("_rows", F.explode(F.array(*[
            F.struct(F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column_name"),
                     F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)
        ])).alias("r"), first.scalar().alias("_first"))
        parts.append(rows.select(
            F.lit(name).alias("table_name"), F.col("_rows").alias("n_rows"), F.lit(len(cols)).alias("n_cols"),
            "r.*", F.array_join(F.transform("_first", lambda v: v[F.col("r.ordinal") - 1]), "|").alias("sample")))
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with at least one NULL and their NULL count."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")
    return rows.filter(F.col("null_count") > 0)
