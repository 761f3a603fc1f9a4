"""The row before over range borders."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators.carry import lag_with_carry


def rows(kind):
    r = random.Random(kind)
    if kind == "one customer, one hour":
        return [("c", r.randrange(3600), i, r.random()) for i in range(800)]
    if kind == "every row a customer":
        return [(f"c{i}", 1, i, float(i)) for i in range(300)]
    if kind == "mixed":
        return [(r.choice(["hot", "hot", None, f"c{i % 50}"]), r.choice([None, 5, i % 90]), i,
                 None if i % 7 == 0 else r.random()) for i in range(900)]
    return [("c", 1, 1, 1.0)][: int(kind)]


@pytest.mark.parametrize("kind", ["one customer, one hour", "every row a customer", "mixed", "1", "0"])
@pytest.mark.parametrize("n", [1, 7, 40])
def test_equals_the_window(spark, kind, n):
    df = spark.createDataFrame(rows(kind), "g string, t int, id long, v double").repartition(3)
    w = Window.partitionBy("g").orderBy("t", "id")
    want = {r.id: r.p for r in df.withColumn("p", F.lag("v").over(w)).collect()}
    got = lag_with_carry(df, ["g"], ["t", "id"], "v", "p", partitions=n)
    assert got.columns == [*df.columns, "p"] and {r.id: r.p for r in got.collect()} == want


def test_one_customer_is_split_with_one_shuffle_of_the_rows(spark):
    df = spark.createDataFrame(rows("one customer, one hour"), "g string, t int, id long, v double")
    got = lag_with_carry(df, ["g"], ["t", "id"], "v", "p", partitions=8)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1 and "hashpartitioning(g" not in plan
    # what else is shuffled is one row per range
    assert plan.count("Exchange hashpartitioning(_range") == 1 and plan.count("Exchange SinglePartition") == 1
