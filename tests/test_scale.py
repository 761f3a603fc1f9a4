"""Distributed ordered operators against plain-window oracles, with a hot key."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators.scale import exact_quantiles, row_numbers


def _skewed(spark, n=3000):
    rng = np.random.default_rng(7)
    g = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))   # key 0 holds a third
    v = rng.integers(0, 200, n).astype(float)
    pdf = pd.DataFrame({"g": g.astype(int), "v": v, "id": np.arange(n), "w": rng.integers(0, 3, n)})
    return spark.createDataFrame(pdf)


def test_global_row_number_and_prefix_sum(spark):
    df = _skewed(spark)
    got = row_numbers(df, ["v", "id"], weight_cols=["w"], num_partitions=7)
    w = Window.orderBy("v", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn_e"),
                    F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_e"))
    j = got.join(exp, "id")
    assert j.filter((F.col("rn") != F.col("rn_e")) | (F.col("cum_w") != F.col("cum_e"))).count() == 0
    assert j.count() == 3000


def test_grouped_row_numbers_keep_null_groups_and_values(spark):
    from decimal import Decimal
    df = _skewed(spark).withColumn("g", F.when(F.col("g") != 3, F.col("g")))
    df = df.withColumns({
        "nan": F.lit(float("nan")), "dec": F.lit(Decimal("1.10")),
        "big": F.when(F.col("id") % 2 == 0, F.lit(2**60 + 1))})
    got = row_numbers(df, ["v", "id"], group_cols=["g"], weight_cols=["w"], num_partitions=9)
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn_e"), F.sum("w").over(w).alias("cum_e"))
    j = got.join(exp, "id")
    assert j.count() == 3000
    assert j.filter((F.col("rn") != F.col("rn_e")) | (F.col("cum_w") != F.col("cum_e"))).count() == 0
    assert got.filter(~F.isnan("nan") | (F.col("dec") != Decimal("1.10"))
                      | ~F.col("big").eqNullSafe(F.when(F.col("id") % 2 == 0, F.lit(2**60 + 1)))).count() == 0


def test_quantiles_of_a_hot_value_stay_small(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 30 != 0, 1.0).otherwise(F.col("id") * 1.0).alias("v"),
                                    F.when(F.col("id") % 2 == 0, "a").alias("g"))
    got = {(r["g"], r["p"]): r["q"] for r in
           exact_quantiles(df, "v", [0.5, 0.99], group_cols=["g"]).collect()}
    pdf = df.toPandas()
    for g in ("a", None):
        x = pdf[pdf.g == g].v if g else pdf[pdf.g.isna()].v
        for p in (0.5, 0.99):
            assert abs(got[g, p] - x.quantile(p)) < 1e-9
    assert exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_gap_with_null_and_hot_customers(spark):
    from tidemart.plans.marts import orders_with_gap
    rows = []
    for i in range(600):
        c = None if i % 5 == 0 else ("hot" if i % 3 == 0 else f"c{i % 40}")
        rows.append((c, f"o{i:04d}", f"2024-01-{1 + i % 28:02d} {i % 24:02d}:{(i // 24) % 60:02d}:00"))
    rows += [("hot", "p1", "2024-02-01 10:00:00"), ("hot", "p2", "2024-02-01 10:00:00"), ("hot", "n", None)]
    df = spark.createDataFrame(rows, "customer_id string, order_id string, t string").selectExpr(
        "customer_id", "order_id", "cast(t as timestamp_ntz) AS purchased_at", "'delivered' AS order_status",
        "cast(null as timestamp_ntz) AS delivered_to_customer_at",
        "cast(null as timestamp_ntz) AS estimated_delivery_at", "1 AS total_order_value",
        "1 AS delivery_days", "1 AS item_count")
    from tidemart.functions.temporal import elapsed_days
    w = Window.partitionBy("customer_id").orderBy("purchased_at", "order_id")
    want = {r["order_id"]: r["e"] for r in df.withColumn("e", elapsed_days(
        F.col("purchased_at"), F.lag("purchased_at").over(w))).collect()}
    got = orders_with_gap(df).collect()
    assert len(got) == len(rows)
    assert {r["order_id"]: r["purchase_gap_days"] for r in got} == want


def test_descending_order(spark):
    df = _skewed(spark)
    got = row_numbers(df, [F.col("v").desc(), F.col("id").desc()], weight_cols=["w"])
    w = Window.orderBy(F.col("v").desc(), F.col("id").desc())
    exp = df.select("id", F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    assert got.join(exp, "id").filter(F.col("cum_w") != F.col("c")).count() == 0


def test_exact_quantiles_match_numpy(spark):
    df = _skewed(spark)
    probs = [0.0, 0.2, 0.33, 0.5, 0.66, 0.8, 1.0]
    got = exact_quantiles(df, "v", probs, group_cols=["g"]).toPandas()
    pdf = df.toPandas()
    for (g, p), q in got.set_index(["g", "p"])["q"].items():
        assert abs(q - pdf[pdf.g == g].v.quantile(p)) < 1e-9
    assert len(got) == pdf.g.nunique() * len(probs)


def test_approx_quantiles_close_to_exact(spark):
    import math
    from tidemart.operators.scale import approx_quantiles
    df = _skewed(spark)
    probs = [0.2, 0.5, 0.8]
    ap = {(r["g"], r["p"]): r["q"] for r in
          approx_quantiles(df, "v", probs, group_cols=["g"]).collect()}
    pdf = df.toPandas()
    assert len(ap) == pdf.g.nunique() * len(probs)
    for (g, p), q in ap.items():
        x = sorted(pdf[pdf.g == g].v)
        h = (len(x) - 1) * p
        # a data value within one position of the exact order statistics
        lo, hi = max(0, math.floor(h) - 1), min(len(x) - 1, math.ceil(h) + 1)
        assert x[lo] <= q <= x[hi], (g, p, q)


def test_positions_with_hot_leading_value_nulls_and_big_ints(spark):
    from tidemart.operators.positions import with_positions
    big = 2**60 + 1
    rows = [(None if i % 7 == 0 else (1 if i % 3 else i), i, big if i % 5 else None, float("nan"))
            for i in range(1000)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d double")
    got = with_positions(df, ["a", "b"], num_partitions=7).orderBy("position").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r["position"] for r in got] == list(range(1000))
    assert [(r["a"], r["b"], r["c"]) for r in got] == [w[:3] for w in want]
    assert all(r["d"] != r["d"] for r in got)
    assert with_positions(df.limit(0), ["a"]).count() == 0


def test_selection_equals_a_sort(spark):
    """Ranks in hot, tiny, NULL and odd-valued groups, in one group and none."""
    import math
    import random
    from tidemart.operators import selection
    r = random.Random(9)
    odd = [0.0, -0.0, 1e-320, -1e300, 1e300, math.inf, -math.inf, 5e-324, 1.0, 1.0 + 2**-52, -1.5, math.nan]
    rows = [("hot", 7.25)] * 900 + [("hot", r.gauss(0, 1e3)) for _ in range(300)]
    rows += [(None, r.choice(odd)) for _ in range(200)] + [("one", 3.0)] + [("near", 1.0 + k * 2**-52) for k in range(50)]
    vals = spark.createDataFrame(rows, "g string, _value double").repartition(5)
    vals = vals.withColumn("_image", selection.double_image(F.col("_value")))
    key = lambda v: (math.isnan(v), 0.0 if v == 0 or math.isnan(v) else v)
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    need = [(g, k) for g, vs in groups.items() for k in {1, len(vs), (len(vs) + 1) // 2, max(1, len(vs) // 3)}]
    got = selection.at_ranks(vals, spark.createDataFrame(need + [("one", 2)], "g string, _rank long").withColumn(
        "k", F.col("_rank")), ["g"]).collect()
    assert len(got) == len(need)
    for x in got:
        vs = sorted(groups[x.g], key=key)
        assert key(x["_value"]) == key(vs[x.k - 1])
        assert x["_rank"] == x.k - sum(key(v) < key(vs[x.k - 1]) for v in vs)
    every = sorted((v for _, v in rows), key=key)
    (x,) = selection.at_ranks(vals, spark.createDataFrame([(1000,)], "_rank long")).collect()
    assert key(x["_value"]) == key(every[999])
    assert selection.at_ranks(vals.limit(0), spark.createDataFrame([(1,)], "_rank long")).count() == 0


def test_hex_images_keep_the_order(spark):
    from tidemart.operators import selection
    df = spark.range(300).select(F.md5(F.col("id").cast("string")).alias("h"))
    rows = df.select("h", selection.hex_image(F.col("h")).alias("i")).collect()
    assert [x.h for x in sorted(rows, key=lambda x: x.h)] == [x.h for x in sorted(rows, key=lambda x: x.i)]
