"""Tables bucketed by order: no shuffle by order; distinct sketches."""

import re

from pyspark.sql import functions as F

from tidemart.catalog import Warehouse
from tidemart.plans import marts, sketches
from tidemart.plans.refresh import BY_ORDER
from tidemart.sources import databases, files
from tidemart.sources.fixtures import RawTables

SF = "/root/testdata/sf0.001"


def by_order(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\(order_id", plan)), plan


def test_models_of_the_batch_do_not_shuffle_by_order(spark, tmp_path):
    source, base = RawTables(spark, SF), str(tmp_path)
    db, four = "raw_buckets", databases.Buckets("order_id", 4)
    for t in RawTables.NAMES:
        databases.replace_table(source.get(t), db, t, base, four if t in BY_ORDER else None)
    w, plain = Warehouse(spark, SF, raw=files.TableRaw(spark, db)), Warehouse(spark, SF)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        n, plan = by_order(w.fct_orders)
        assert n == 0 and "SortMergeJoin" in plan and by_order(plain.fct_orders)[0] == 3
        fct = databases.replace_table(w.fct_orders, db, "fct_orders", base, four)
        for df in (marts.payment_features(fct, w.stg_order_payments), marts.review_features(fct, w.stg_order_reviews),
                   marts.mart_customer_features(fct, w.dim_customers, w.stg_order_payments, w.stg_order_reviews)):
            assert by_order(df)[0] == 0
        got = marts.mart_customer_features(fct, w.dim_customers, w.stg_order_payments, w.stg_order_reviews)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.mart_customer_features.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # the next version keeps the buckets, and another number of them is another shape
    again = databases.replace_table(fct.limit(100), db, "fct_orders", base, four)
    assert again.count() == 100 and by_order(again.groupBy("order_id").count())[0] == 0
    assert databases.replace_table(again, db, "fct_orders", base, databases.Buckets("order_id", 2)).count() == 100
    assert databases.replace_table(again, db, "fct_orders", base).count() == 100
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_sketches_of_months_merge_into_years(spark, tmp_path):
    rows = spark.range(0, 240_000, 1, 6).select(
        (F.col("id") % 24).alias("month"), F.xxhash64(F.col("id") % 70_001).alias("customer"))
    months = sketches.store(sketches.distinct_sketches(rows, ["month"], ["customer"]), str(tmp_path / "s"))
    years = sketches.estimates(sketches.merge(months, [F.floor(F.col("month") / 12).alias("year")])).collect()
    exact = {r.year: r.n for r in rows.groupBy(F.floor(F.col("month") / 12).alias("year")).agg(
        F.count_distinct("customer").alias("n")).collect()}
    assert len(years) == 2 and sum(r.rows for r in years) == 240_000
    for r in years:
        assert abs(r.approx_customer - exact[r.year]) <= sketches.error_bound() * exact[r.year]
    whole = sketches.estimates(sketches.merge(months)).first()
    assert abs(whole.approx_customer - 70_001) <= sketches.error_bound() * 70_001
    coarse = sketches.distinct_sketches(rows, [], ["customer"], precision=8)
    assert abs(sketches.estimates(coarse).first().approx_customer / 70_001 - 1) <= sketches.error_bound(8)
    assert sketches.estimates(sketches.distinct_sketches(rows.limit(0), ["month"], ["customer"])).count() == 0
