"""Statements over lazily bound models."""

import pytest
from pyspark.errors import AnalysisException

from tidemart.catalog import Warehouse
from tidemart.sources.statements import read_sql

SF = "/root/testdata/sf0.001"


class Watched(Warehouse):
    """Remembers which models were asked for by name."""

    def __init__(self, *a):
        super().__init__(*a)
        self.asked = []

    def model(self, name):
        self.asked.append(name)
        return super().model(name)


@pytest.fixture()
def w(spark):
    return Watched(spark, SF)


def views(spark):
    return [t.name for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("_model")]


def test_join_with_aliases_and_dates(spark, w):
    df = read_sql(spark, """
        SELECT o.order_id, o.purchased_at::string AS bought, c.state
        FROM marts.fct_orders o JOIN marts.dim_customers c ON c.customer_id = o.customer_id
    """, w, parse_dates=["bought"])
    assert dict(df.dtypes)["bought"] == "timestamp_ntz"
    assert w.asked == ["fct_orders", "dim_customers"] and views(spark) == []
    want = w.fct_orders.join(w.dim_customers, "customer_id").select("order_id", "purchased_at", "state")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


def test_raw_tables_casts_and_grouping(spark, w):
    scores = read_sql(spark, "SELECT review_score::int AS s FROM raw.order_reviews WHERE review_score IS NOT NULL", w)
    assert dict(scores.dtypes) == {"s": "int"} and w.asked == []
    top = read_sql(spark, """
        SELECT p.category_name_en, sum(i.price + i.freight_value) AS revenue, count(DISTINCT i.order_id) AS n
        FROM staging.stg_order_items i JOIN marts.dim_products p ON p.product_id = i.product_id
        WHERE p.category_name_en <> 'uncategorized' GROUP BY 1 ORDER BY 2 DESC LIMIT 3""", w)
    assert top.count() == 3 and w.asked == ["stg_order_items", "dim_products"]
    used = read_sql(spark, "select f.*, l.is_churned from marts.mart_customer_features f "
                           "join marts.mart_churn_labels l using (customer_id)", w)
    assert used.columns[0] == "customer_id" and used.columns[-1] == "is_churned"


def test_names_without_alias_in_strings_and_twice(spark, w):
    df = read_sql(spark, "SELECT 'from marts.dim_sellers' AS t, dim_sellers.state -- marts.dim_products\n"
                         "FROM `marts`.`dim_sellers` WHERE seller_id IN (SELECT seller_id FROM marts.dim_sellers) "
                         "AND seller_id IN (SELECT seller_id FROM dim_sellers s2)", w)
    assert df.count() == w.dim_sellers.count() and df.first()["t"] == "from marts.dim_sellers"
    assert set(w.asked) == {"dim_sellers"}
    cte = read_sql(spark, "WITH dim_sellers AS (SELECT 1 AS one) SELECT * FROM dim_sellers", w)
    assert cte.columns == ["one"]  # the statement's own names come first


def test_faults(spark, w):
    for bad in ("SELECT * FROM marts.nothing", "SELECT * FROM staging.fct_orders", "SELECT nope FROM marts.fct_orders",
                "SELECT * FROM elsewhere.fct_orders"):
        with pytest.raises(AnalysisException):
            read_sql(spark, bad, w)
    with pytest.raises(ValueError):
        read_sql(spark, "SELECT order_id FROM marts.fct_orders", w, parse_dates=["x"])
    assert views(spark) == []
