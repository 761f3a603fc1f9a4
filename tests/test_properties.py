"""Property tests: binning rules against pandas on random inputs."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.functions.bins import fixed_bins, rank_quintile


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=2, max_value=3000))
def test_rank_quintile_equals_pandas(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"))
    got = [r[0] for r in df.orderBy("r").select(rank_quintile(F.col("r"), F.lit(n))).collect()]
    exp = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == exp


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=1100), min_size=1, max_size=60))
def test_fixed_bins_equal_pandas_cut(spark, vals):
    edges, labels = [0, 7, 14, 21, 999], ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(fixed_bins(F.col("x"), edges, labels)).collect()]
    exp = pd.cut(pd.Series(vals, dtype=float), edges, labels=labels)
    assert got == [None if pd.isna(v) else v for v in exp.astype(object)]
