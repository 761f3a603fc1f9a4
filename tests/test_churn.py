"""Training rules on a small frame with signal."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemart.operators.positions import write_and_reread
from tidemart.plans import churn as C
from tidemart.plans import shapley


@pytest.fixture(scope="module")
def ds(spark):
    rng = random.Random(0)
    rows = []
    for i in range(600):
        x = [rng.random() * 10 for _ in C.FEATURE_CANDIDATES]
        noisy = x[0] + x[3] - x[5] + rng.gauss(0, 2)
        rows.append((f"c{i}", rng.choice(["SP", "RJ", None]), *[None if rng.random() < .05 else v for v in x],
                     int(noisy > 4)))
    cols = ", ".join(f"{c} double" for c in C.FEATURE_CANDIDATES)
    return spark.createDataFrame(rows, f"customer_id string, customer_state string, {cols}, is_churned int")


@pytest.fixture(scope="module")
def prep(ds):
    return C.prepare(ds)


def test_stop_round_rule():
    assert C.stop_round([3, 2, 1], 2) == (3, False)
    assert C.stop_round([3, 2, 2.5, 2.0, 9], 2) == (2, True)
    assert C.stop_round([3, 2, 2.5, 1.9, 9, 9, 9], 2) == (4, True)
    assert C.stop_round([1], 50) == (1, False)


def test_split_is_stratified_and_null_safe(spark):
    df = spark.createDataFrame([(f"k{i}", None if i % 7 == 0 else i % 2) for i in range(210)] + [(None, 1)],
                               "customer_id string, is_churned int")
    got = C.stratified_split(df).groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()
    assert sum(r["n"] for r in got) == 211 and len(got) == 3
    assert all(r["t"] == -(-r["n"] // 5) for r in got)


def test_patience_keeps_more_than_one_tree(prep, tmp_path):
    b = C.final_model(prep.train, 3.0, rounds=40, patience=5)
    assert b.best_round > 1 and b.model.getNumTrees == b.best_round
    seen = b.losses[:b.rounds_tried]
    assert min(seen) == b.losses[b.best_round - 1]
    assert b.rounds_tried == b.best_round + 5 or b.rounds_tried == 40
    given = C.boosted_contributions(b.model, prep.test, str(tmp_path / "nodes"))
    assert given.filter(F.abs(F.aggregate("contributions", F.col("base"), lambda s, x: s + x)
                              - F.col("margin")) > 1e-9).count() == 0
    names = {r["feature"]: r["importance"] for r in shapley.importance(given, prep.features).collect()}
    assert set(names) == set(prep.features) and names["frequency"] > names["monetary"] >= 0


def test_final_model_fits_no_round_again(prep, monkeypatch):
    fitted, gbt = [], C.gbt
    monkeypatch.setattr(C, "gbt", lambda rounds, w: fitted.append(rounds) or gbt(rounds, w))
    b = C.final_model(prep.train, 3.0, rounds=40, patience=5)
    assert fitted == [40] and b.best_round < 40
    fit = prep.train.join(b.validation.select(C.KEY), C.KEY, "left_anti").withColumn("w", C.active_weight(3.0))
    again = C.scored(gbt(b.best_round, 3.0).fit(fit), prep.test).select(C.KEY, F.col("churn_probability").alias("p"))
    both = C.scored(b.model, prep.test).join(again, C.KEY)
    assert both.count() == prep.test.count() and both.filter("abs(p - churn_probability) > 1e-9").isEmpty()
    assert b.model.numFeatures == len(prep.features) and len(b.model.featureImportances) == len(prep.features)
    # the last round is still the best: all rounds come next, not twice as many
    fitted.clear()
    monkeypatch.setattr(C, "FIRST_ROUNDS", 3)
    b = C.final_model(prep.train, 3.0, rounds=9, patience=1)
    assert fitted == [3, 9] and b.model.getNumTrees == b.best_round


def test_dataset_builds_the_order_fact_once(spark, monkeypatch):
    from tidemart.keys import churn as K
    seen = {}
    monkeypatch.setattr(K, "write_and_reread", lambda df, name: seen.setdefault(name, write_and_reread(df, name)))
    monkeypatch.setattr(K.C, "ml_dataset", lambda f, labels: labels)
    got = K.written_dataset(spark, "/root/testdata/sf0.001")
    assert list(seen) == ["ml-orders", "ml-dataset"] and got.count() > 0


def test_baseline_gradient_vanishes(prep):
    m = C.logistic_baseline(prep.train)
    g = C.stationarity(m, prep.train, len(prep.features)).collect()
    assert len(g) == len(prep.features) + 1 and max(abs(r["gradient"]) for r in g) < 1e-2


def test_baseline_scores_after_the_session_observed_rows(spark, prep):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get["rows"] == 5
    m = C.logistic_baseline(prep.train)
    assert C.scored(m, prep.test).filter("churn_probability between 0 and 1").count() == prep.test.count()
    assert C.linear_gap(m, prep.test) < 1e-6


def test_saved_pipeline_scores_raw_rows(spark, ds, prep, tmp_path):
    model = C.gbt(3, 2.0).fit(prep.train.withColumn("w", C.active_weight(2.0)))
    C.save_model(prep.stages, model, prep.features, prep.med, 0.4, str(tmp_path / "m"), spark)
    loaded, meta = C.load_model(str(tmp_path / "m"), spark)
    assert meta.first()["state_labels"] == ["RJ", "SP", "Unknown"]
    raw = ds.drop("is_churned").union(spark.createDataFrame(
        [("new", "unseen state", *[None] * len(C.FEATURE_CANDIDATES))], ds.drop("is_churned").schema))
    again = C.probability(loaded.transform(raw)).select(C.KEY, F.col("churn_probability").alias("p"))
    here = C.probability(model.transform(prep.all)).select(C.KEY, "churn_probability")
    j = here.join(again, C.KEY, "right")
    assert j.count() == 601
    assert j.filter(F.abs(F.col("p") - F.col("churn_probability")) > 1e-12).count() == 0
    assert j.filter("p is null").count() == 0


def test_shapley_values_equal_enumeration_of_all_subsets(spark, tmp_path):
    """Conditional expectations by walking the trees, all subsets of features."""
    from itertools import combinations
    from math import factorial

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rng = random.Random(3)
    rows = [(f"k{i}", *[rng.randrange(5) * 1.0 for _ in range(4)]) for i in range(150)]
    rows = [(*r, int(r[1] + r[2] * r[3] + rng.random() * 3 > 7), rng.choice([1.0, 3.0])) for r in rows]
    df = spark.createDataFrame(rows, "customer_id string, a double, b double, c double, d double, y int, w double")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)
    model = GBTClassifier(labelCol="y", weightCol="w", maxIter=4, maxDepth=4, seed=1).fit(df)
    got = {r.customer_id: r for r in C.boosted_contributions(model, df, str(tmp_path / "n")).collect()}
    trees = {}
    for n in shapley.node_table(spark, model, str(tmp_path / "again")).collect():
        trees.setdefault(n.tree, {})[n.id] = n

    def expect(nodes, i, x, known):
        n = nodes[i]
        if n.left < 0:
            return n.value
        if n.feature in known:
            return expect(nodes, n.left if x[n.feature] <= n.threshold else n.right, x, known)
        return sum(nodes[c].weight / n.weight * expect(nodes, c, x, known) for c in (n.left, n.right))

    def value(x, known):
        return sum(w * expect(trees[t], 0, x, known) for t, w in enumerate(model.treeWeights))

    for r in rows[:12]:
        x, have = r[1:5], got[r[0]]
        assert abs(have.base - value(x, ())) < 1e-9
        for i in range(4):
            others = [j for j in range(4) if j != i]
            want = sum(factorial(k) * factorial(3 - k) / 24 * (value(x, (*s, i)) - value(x, s))
                       for k in range(4) for s in combinations(others, k))
            assert abs(want - have.contributions[i]) < 1e-9
        assert abs(have.base + sum(have.contributions) - have.margin) < 1e-9


def test_a_constant_model_fails_its_keys(spark, prep, monkeypatch, tmp_path):
    """Four training keys turn red for a model that ignores its features."""
    from dataclasses import replace

    from tidemart.keys import churn as K
    flat = prep.train.withColumn("features", F.transform(C.vector_to_array("features"), lambda x: F.lit(0.0)))
    from pyspark.ml.functions import array_to_vector
    flat = flat.withColumn("features", array_to_vector("features")).withColumn("w", F.lit(1.0))
    trees, line = C.gbt(2, 1.0).fit(flat), C.logistic_baseline(flat.drop("w"))
    boosted = C.Boosted(trees, 2, 2, [1.0, 0.9], replace(prep).test)
    parts = {"prep": prep, "final": (boosted, 0.5), "search": (1, []), "logreg": line}
    monkeypatch.setattr(K, "trained", lambda spark, sf, part: parts[part])
    no = lambda df, c: set(r[c] for r in df.collect()) == {False}
    assert no(K.ml_boosted_trees(spark, ""), "beats_constant")
    assert no(K.ml_score_all(spark, ""), "varies")
    assert no(K.ml_feature_importance(spark, "").filter("model != 'split_gain'"), "adds_up")
    with pytest.raises(Exception, match="edges must be unique"):
        K.churn_scores(spark, "").collect()
    good = C.gbt(5, 1.0).fit(prep.train.withColumn("w", F.lit(1.0)))
    parts["final"] = (C.Boosted(good, 5, 5, [1.0] * 5, prep.test), 0.5)
    parts["logreg"] = C.logistic_baseline(prep.train)
    assert {r.beats_constant for r in K.ml_boosted_trees(spark, "").collect()} == {True}
    assert {tuple(r)[1:] for r in K.ml_score_all(spark, "").collect()} == {(True, True, True)}
    assert {r.adds_up for r in K.ml_feature_importance(spark, "").collect()} == {True}


def _margins(model, df, name):
    return model.transform(df).select(C.KEY, C.vector_to_array("rawPrediction")[1].alias(name))


def test_grown_trees_are_sparks_however_rows_are_dealt(spark):
    """Large nodes only: in small ones several splits part the rows alike, and
    Spark chooses among these by the rounding of its sums."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    from tidemart.plans import boosting
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        x = [rng.choice([0.0, rng.gauss(0, 3)]), float(rng.randrange(6)), rng.random(), round(rng.random() * 40)]
        rows.append((f"c{i}", [float(v) for v in x], int(x[0] + x[1] * x[2] + rng.gauss(0, 1) > 1)))
    df = spark.createDataFrame(rows, "customer_id string, x array<double>, is_churned int")
    df = df.withColumn("features", array_to_vector("x")).withColumns({"w3": C.active_weight(3), "w8": C.active_weight(8)})
    booster = boosting.Booster(8, 0.2, 3, C.SEED, C.LABEL)
    grown = {n: booster.fit_each(df, ["w3", "w8"], tasks=n) for n in (1, 3)}
    for i, w in enumerate(("w3", "w8")):
        spark_model = GBTClassifier(labelCol=C.LABEL, weightCol=w, maxIter=8, stepSize=0.2, maxDepth=3).fit(df)
        want = _margins(spark_model, df, "want")
        one, three = (_margins(grown[n][i], df, f"from{n}") for n in (1, 3))
        got = want.join(one, C.KEY).join(three, C.KEY)
        assert got.count() == 3000 and got.filter("from1 != from3").isEmpty()
        assert got.filter("abs(from1 - want) > 1e-9").isEmpty()
        assert grown[3][i].totalNumNodes == spark_model.totalNumNodes
        assert max(abs(a - b) for a, b in zip(grown[3][i].featureImportances, spark_model.featureImportances)) < 1e-9


def test_rounds_are_not_jobs(spark, prep):
    sc = spark.sparkContext
    sc.setJobGroup("boosting", "thirty rounds")
    try:
        model = C.gbt(30, 3.0).fit(prep.train.withColumn("w", C.active_weight(3.0)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees == 30
    assert len(sc.statusTracker().getJobIdsForGroup("boosting")) < 30


def test_booster_refuses_rows_it_cannot_use(spark, prep):
    df = prep.train.withColumn("w", F.lit(1.0))
    for bad in (df.withColumn(C.LABEL, F.lit(None).cast("int")), df.withColumn("w", F.lit(0.0)), df.filter("false")):
        with pytest.raises(ValueError, match="rows without"):
            C.gbt(2, 1.0).fit(bad)


def test_split_points_follow_weights_and_zeros():
    import numpy as np

    from tidemart.plans import boosting
    one = lambda *v: np.array(v, float)
    assert boosting.split_points(one(3, 1, 1), one(1, 1, 1), 3.0, 31) == [2.0]
    assert boosting.split_points(one(5, 5), one(1, 2), 3.0, 31) == []
    assert boosting.split_points(one(0, 0, -1, 2), one(1, 1, 1, 1), 4.0, 31) == [-0.5, 1.0]
    assert boosting.split_points(np.arange(1.0, 9), np.ones(8), 8.0, 3) == [2.5, 4.5, 6.5]
    assert boosting.split_points(one(1, 2, 3, 4), one(9, 1, 1, 1), 12.0, 2) == [1.5, 2.5]


@pytest.mark.parametrize("total", [900.0, 100.0])
def test_a_sample_heavier_than_its_share_makes_more_thresholds(spark, monkeypatch, total):
    """As in Spark, they are all tried; the last one parts the labels here."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    from tidemart.plans import boosting
    points = boosting.split_points(np.arange(1.0, 1001), np.ones(1000), total, boosting.BINS - 1)
    assert len(points) >= boosting.BINS * 1000 // total - 1 > boosting.BINS
    monkeypatch.setattr(boosting.Booster, "_points", lambda *_: [[points, []]])
    rows = [(f"c{i}", [float(i), 0.0], int(i > points[-1])) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "customer_id string, x array<double>, is_churned int")
    df = df.withColumns({"features": array_to_vector("x"), "w": F.lit(1.0)})
    model, = boosting.Booster(2, 0.2, 1, C.SEED, C.LABEL).fit_each(df, ["w"], tasks=2)
    assert f"<= {points[-1]}" in model.toDebugString
    assert C.scored(model, df).filter(F.col("prediction") != F.col(C.LABEL)).isEmpty()
