"""Plan shape regressions, read from ``explain`` output."""

import contextlib
import io
import re

from tidemart.catalog import Warehouse
from tidemart.plans import marts

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_prunes_columns_and_pushes_filters(spark):
    p = plan(Warehouse(spark, SF).fct_orders)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    line = [s for s in schemas if "l_extendedprice" in s and "l_linestatus" not in s][0]
    assert "l_shipdate" not in line and "l_partkey" not in line   # items read 4 columns
    assert "EqualTo(l_linestatus,F)" in p                          # payments filter pushed
    # both children are aggregated before the joins (partial + final)
    assert p.count("HashAggregate") >= 4


def test_payment_features_skip_item_aggregation(spark):
    w = Warehouse(spark, SF)
    p = plan(marts.payment_features(w.fct_orders, w.stg_order_payments))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p  # 2 order columns
    assert "count(order_item_id" not in p   # no item totals for a payment-only feature
    assert "l_extendedprice" not in p       # payment values are not needed either


def test_reference_date_is_a_scalar_subquery(spark):
    p = plan(Warehouse(spark, SF).mart_churn_labels)
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
