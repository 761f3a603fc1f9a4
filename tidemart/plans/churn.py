"""Churn dataset, preprocessing, models and scoring on Spark ML.

Everything that touches customer rows is a distributed DataFrame job:
stratified split at a cut-off hash per class, medians by counting selection of
ranks, class weights by a two-row aggregate, models by
``pyspark.ml`` estimators. Only bounded results (13 medians, state labels, a
threshold, one loss per boosting round) reach the driver. Preprocessing is a
fitted ``PipelineModel`` that starts from raw feature-mart rows, so a saved
model scores new customers by itself.

Differences from the source notebook, on purpose:
* weight search, early stopping and threshold tuning look at a validation
  split carved from the training rows, never at the test rows;
* gradient-boosted trees are those of Spark's ``GBTClassifier`` (depth 5, the
  analogue of 31 leaves), grown by ``boosting``; not the same algorithm, so
  scores are comparable only in range.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bins import edge_bins
from ..operators.positions import write_and_reread
from ..operators import selection
from ..operators.scale import exact_quantiles, quantile_edges
from ..session import work_path
from ..sources import versions
from . import boosting, shapley
from . import metrics as M

LABEL = "is_churned"
KEY = "customer_id"
# Candidate features (13th input is the encoded state).
FEATURE_CANDIDATES = [
    "frequency", "monetary", "avg_order_value", "avg_delivery_days", "max_delivery_days",
    "late_delivery_rate", "avg_review_score", "min_review_score", "bad_review_rate",
    "credit_card_rate", "avg_installments", "avg_items_per_order",
]
STATE_ENCODED = "state_encoded"
UNKNOWN_STATE = "Unknown"
TEST_FRACTION = 0.2
SEED = 42
ACTIVE_WEIGHTS = [3, 5, 8, 10]
SEARCH_ROUNDS = 300
FINAL_ROUNDS = 500
PATIENCE = 50
FIRST_ROUNDS = 60  # rounds of the first attempt
STEP_SIZE = 0.05
MAX_DEPTH = 5
LOGREG_MAX_ITER = 1000
LOGREG_C = 1.0
# Risk quantiles, segment labels and actions.
RISK_PROBS = [0.33, 0.66]
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]
RISK_ACTIONS = {
    "High Risk": "Immediate win-back campaign",
    "Medium Risk": "Nurture email sequence",
    "Low Risk": "Standard newsletter",
}


def ml_dataset(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features joined with the label (``join ... using (customer_id)``)."""
    return features.join(labels.select(KEY, LABEL, "days_since_last_order"), KEY)


def model_features(ds: DataFrame) -> list[str]:
    present = [c for c in FEATURE_CANDIDATES if c in ds.columns]
    return present + [STATE_ENCODED]


def class_distribution(ds: DataFrame) -> DataFrame:
    g = ds.groupBy(LABEL).agg(F.count(F.lit(1)).alias("customers"))
    total = ds.agg(F.count(F.lit(1))).scalar()
    return g.withColumn("rate", F.col("customers").cast("double") / total.cast("double"))


NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def numeric_columns(ds: DataFrame, exclude=(LABEL,)) -> list[str]:
    return [f.name for f in ds.schema.fields
            if (f.dataType.simpleString() in NUMERIC or f.dataType.simpleString().startswith("decimal"))
            and f.name not in exclude]


def feature_correlation(ds: DataFrame, label: str = LABEL, digits: int = 9) -> DataFrame:
    """Pearson correlation of every numeric column with the label.

    Pairs with a NULL are skipped; a constant column gives NULL, not an error
    (``corr`` divides by zero under ANSI). One partial aggregate pass.
    """
    cols = numeric_columns(ds, exclude=(label,))
    y = F.col(label).cast("double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        aggs.append(F.try_divide(F.covar_pop(xs, ys),
                                 F.stddev_pop(xs) * F.stddev_pop(ys)).alias(c))
    one = ds.agg(*aggs)
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c), digits).alias("correlation"))
        for c in cols])).alias("r")).select("r.*")
    return rows


def state_indexer(ds: DataFrame) -> tuple[SQLTransformer, StringIndexerModel]:
    """State -> index in alphabetical order, missing state -> 'Unknown'."""
    fill = SQLTransformer(statement=(
        f"SELECT *, coalesce(customer_state, '{UNKNOWN_STATE}') AS _state FROM __THIS__"))
    idx = StringIndexer(inputCol="_state", outputCol=STATE_ENCODED,
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    return fill, idx.fit(fill.transform(ds))


def encode_state(ds: DataFrame) -> tuple[DataFrame, StringIndexerModel]:
    fill, model = state_indexer(ds)
    return model.transform(fill.transform(ds)).drop("_state"), model


def _ceil_fraction(n: Column, fraction: float) -> Column:
    k = int(round(fraction * 1_000_000))
    return F.floor((n * k + 999_999) / 1_000_000).cast("long")


def stratified_split(ds: DataFrame, fraction: float = TEST_FRACTION, seed: int = SEED,
                     label: str = LABEL, key: str = KEY, out: str = "is_test") -> DataFrame:
    """Deterministic stratified split: per class, the ``ceil(fraction * n_class)``
    rows with the smallest (md5(key:seed), key) go to the test side.

    Nothing is ordered: the hash at each class's cut is selected by counting,
    and the keys are compared only among rows of that very hash.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    image = selection.hex_image(h)
    small = ds.select(F.col(label).alias("_label"), image.alias("_image"), image.alias("_value"))
    need = small.groupBy("_label").agg(F.count(F.lit(1)).alias("_n")).select(
        "_label", _ceil_fraction(F.col("_n"), fraction).alias("_rank"))
    at = selection.at_ranks(small, need, ["_label"]).select(
        F.col("_label").alias("_cls"), F.col("_value").alias("_cut_image"), F.col("_rank").alias("_nth"))
    on = lambda left: left[label].eqNullSafe(at["_cls"])
    # the rows of the cut's image, one a class unless two hashes begin alike
    place = F.row_number().over(Window.partitionBy("_cls").orderBy("_h", "_k"))
    ties = (ds.withColumns({"_h": h, "_k": F.col(key)}).join(at, on(ds) & (image == F.col("_cut_image")))
            .select("_cls", "_cut_image", "_nth", "_h", "_k").withColumn("_place", place)
            .filter("_place = _nth").select(F.col("_cls"), "_cut_image", F.struct("_h", "_k").alias("_cut")))
    cut = write_and_reread(ties, "split-cuts")  # one row a class
    below = F.struct(h.alias("_h"), F.col(key).alias("_k")) <= F.col("_cut")
    return (ds.join(cut, ds[label].eqNullSafe(cut["_cls"]), "left")
            .withColumn(out, F.coalesce(below, F.lit(False)))
            .drop("_cls", "_cut", "_cut_image"))


def medians(train: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median of each column over ``train`` (NULLs skipped): (feature, q)."""
    long = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("r")).select("r.*")
    return exact_quantiles(long, "value", [0.5], group_cols=["feature"]).drop("p")


def impute(df: DataFrame, med: dict[str, float], cols: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.coalesce(F.col(c).cast("double"), F.lit(med.get(c))).alias(c)
                       for c in cols])


def collect_medians(train: DataFrame, cols: list[str]) -> dict[str, float]:
    """Bounded collect: one value per feature."""
    return {r["feature"]: r["q"] for r in medians(train, cols).collect()}


def balanced_weight(df: DataFrame, label: str = LABEL) -> Column:
    """n / (2 n_class), as sklearn's class_weight='balanced'."""
    n = df.agg(F.count(F.lit(1))).scalar()
    n1 = df.agg(F.sum(F.col(label))).scalar()
    return F.when(F.col(label) == 1, n / (2 * n1)).otherwise(n / (2 * (n - n1)))


def active_weight(w: float, label: str = LABEL) -> Column:
    return F.when(F.col(label) == 0, F.lit(float(w))).otherwise(F.lit(1.0))


def probability(pred: DataFrame, out: str = "churn_probability") -> DataFrame:
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


@dataclass
class Prepared:
    features: list[str]
    train: DataFrame
    test: DataFrame
    all: DataFrame
    med: dict
    stages: PipelineModel


def _literal(x: float | None) -> str:
    return f"{float(x or 0.0)!r}D"


def prepare(ds: DataFrame) -> Prepared:
    """Encode, split 80/20 stratified, impute medians fitted on train.

    ``stages`` turns raw feature-mart rows into ``features`` (a feature without
    any training value is imputed with 0). The prepared rows are written once,
    partitioned by key: trees and gradients read them once per round.
    """
    feats = model_features(ds)
    fill, indexer = state_indexer(ds)
    split = write_and_reread(stratified_split(ds), "split")
    train = split.filter(~F.col("is_test"))
    med = collect_medians(indexer.transform(fill.transform(train)), feats)
    inputs = ", ".join(f"coalesce(CAST({f} AS DOUBLE), {_literal(med.get(f))}) AS _in_{f}" for f in feats)
    impute_all = SQLTransformer(statement=f"SELECT *, {inputs} FROM __THIS__")
    asm = VectorAssembler(inputCols=[f"_in_{f}" for f in feats], outputCol="features")
    stages = PipelineModel(stages=[fill, indexer, impute_all, asm])
    ready = write_and_reread(
        stages.transform(split).select(KEY, LABEL, "is_test", "features").repartition(KEY), "prepared")
    return Prepared(feats, ready.filter(~F.col("is_test")), ready.filter(F.col("is_test")), ready, med, stages)


def logistic_baseline(train: DataFrame) -> LogisticRegressionModel:
    """The model as read back from the work folder: a freshly fitted one carries
    its training summary and with it the session, which no task can be sent once
    anything in the session has been observed (``versions.publish`` does)."""
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="w",
                            maxIter=LOGREG_MAX_ITER, regParam=1.0 / (LOGREG_C * n),
                            elasticNetParam=0.0, standardization=False)
    path = work_path(train.sparkSession, "models", f"logreg-{uuid.uuid4().hex}")
    lr.fit(train.withColumn("w", balanced_weight(train))).save(path)
    return LogisticRegressionModel.load(path)


def gbt(rounds: int, active_w: float) -> boosting.Booster:
    return boosting.Booster(rounds, STEP_SIZE, MAX_DEPTH, SEED, LABEL)


def scored(model, df: DataFrame) -> DataFrame:
    return probability(model.transform(df)).select(
        KEY, LABEL, "churn_probability", F.col("prediction").cast("int").alias("prediction"))


def weight_search(train: DataFrame, weights=ACTIVE_WEIGHTS, rounds: int = SEARCH_ROUNDS,
                  parallelism: int = 4):
    """Try each weight of the active class; keep the best active-class F1.

    Fit on 80% of train, measure on the other 20% (validation), strictly
    greater F1 wins (first weight on ties). The candidates' trees grow together,
    in one pass.
    """
    sp = write_and_reread(
        stratified_split(train.drop("is_test"), seed=SEED + 1, out="is_val").repartition(KEY), "search")
    fit, val = sp.filter(~F.col("is_val")), sp.filter(F.col("is_val"))

    names = [f"w{i}" for i in range(len(weights))]
    models = gbt(rounds, 1).fit_each(
        fit.withColumns({c: active_weight(w) for c, w in zip(names, weights)}), names)

    def one(w, m):
        s = scored(m, val)
        s = write_and_reread(s, "search-scores")
        apr = M.active_precision_recall(s, LABEL, "prediction").first()
        auc = M.roc_auc(s, LABEL, "churn_probability").first()["roc_auc"]
        n = s.agg(F.count_if(F.col(LABEL) == 0).alias("a"), F.count_if(F.col(LABEL) == 1).alias("c")).first()
        return (w, apr["precision"], apr["recall"], apr["f1"], auc, n["a"], n["c"])

    # candidates are judged independently: submit them concurrently, as the
    # ``parallelism`` option of Spark's tuning estimators does
    with ThreadPoolExecutor(max_workers=min(parallelism, len(weights))) as ex:
        rows = list(ex.map(one, weights, models))
    best_w, best_f1 = 1, 0.0
    for w, _, _, f1, *_ in rows:  # in grid order: strictly greater wins
        if f1 > best_f1:
            best_w, best_f1 = w, f1
    return best_w, rows


def stop_round(losses: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(best round, whether patience ended): rounds count from 1; training ends
    ``patience`` rounds after the best loss, the earliest of equal ones."""
    best = 0
    for i, x in enumerate(losses):
        if x < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


@dataclass
class Boosted:
    model: object
    best_round: int
    rounds_tried: int
    losses: list[float]
    validation: DataFrame


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model as it was after ``n`` rounds: later rounds leave earlier trees as they are."""
    spark = SparkSession.active()
    ml, java = spark._jvm.org.apache.spark.ml, model._java_obj
    trees = spark.sparkContext._gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    weights = spark.sparkContext._gateway.new_array(spark._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:n], model.treeWeights)):
        trees[i], weights[i] = tree, weight
    cut = ml.classification.GBTClassificationModel(java.uid(), trees, weights, model.numFeatures, model.numClasses)
    return model._copyValues(GBTClassificationModel(cut))


def final_model(train: DataFrame, active_w: float, rounds: int = FINAL_ROUNDS,
                patience: int = PATIENCE) -> Boosted:
    """Boosted trees that stop ``patience`` rounds after the best weighted loss
    on a validation split of ``train``.

    Spark's own stopping rule has no patience, so rounds are fitted in growing
    attempts, judged by the loss after each round: twice as many while patience
    is running, all of them while the last round is still the best. The model is
    the first trees of the last attempt, up to the best round.
    """
    sp = write_and_reread(
        stratified_split(train.drop("is_test"), seed=SEED + 2, out="is_val")
        .withColumn("w", active_weight(active_w)).repartition(KEY), "final")
    fit, val = sp.filter(~F.col("is_val")), sp.filter(F.col("is_val"))
    tried = min(rounds, max(FIRST_ROUNDS, patience + 1))
    while True:
        model = gbt(tried, active_w).fit(fit)
        losses = list(model.evaluateEachIteration(val))
        best, ended = stop_round(losses, patience)
        if ended or tried >= rounds:
            break
        tried = rounds if best == tried else min(rounds, 2 * tried)
    return Boosted(first_trees(model, best), best, min(tried, best + patience), losses, val)


def risk_segments(scores: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """Low / Medium / High by the 33rd and 66th percentile (right-closed bins
    [0, p33], (p33, p66], (p66, 1]) and the action for each segment."""
    q = exact_quantiles(scores, prob, RISK_PROBS)
    edges = [F.lit(0.0), *quantile_edges(q, RISK_PROBS), F.lit(1.0)]
    seg = edge_bins(F.col(prob), edges, RISK_LABELS)
    act = F.create_map(*[x for k, v in RISK_ACTIONS.items() for x in (F.lit(k), F.lit(v))])
    return scores.withColumn("risk_segment", seg) \
                 .withColumn("recommended_action", act[F.col("risk_segment")])


def risk_distribution(seg: DataFrame) -> DataFrame:
    return seg.groupBy("risk_segment").agg(F.count(F.lit(1)).alias("customers"))


def save_model(stages: PipelineModel, model, features: list[str], med: dict, threshold: float,
               path: str, spark) -> None:
    """One pipeline from raw feature-mart rows to probabilities (state index,
    imputation, assembly, model), plus a metadata table (features, medians,
    state labels, threshold). Both become one version: a reader never finds the
    threshold of another model."""
    version = versions.new_version(path)
    PipelineModel(stages=[*stages.stages, model]).write().save(f"{version}/model")
    labels = stages.stages[1].labels
    meta = spark.createDataFrame(
        [(i, f, float(med.get(f)) if med.get(f) is not None else None, float(threshold), labels)
         for i, f in enumerate(features)],
        "position int, feature string, median double, threshold double, state_labels array<string>")
    meta.write.parquet(f"{version}/metadata")
    versions.commit(spark, version)


def load_model(path: str, spark) -> tuple[PipelineModel, DataFrame]:
    """The newest model that was saved whole."""
    version = versions.current(spark, path)
    if version is None:
        raise versions.NoVersion(path)
    return PipelineModel.load(f"{version}/model"), spark.read.parquet(f"{version}/metadata")


def boosted_contributions(model, df: DataFrame, path: str) -> DataFrame:
    """Per row of ``df``: ``base`` and each feature's Shapley ``contributions``
    to the margin (``path``: a folder for the model's node table), and the
    ``margin`` itself as the model gives it."""
    given = shapley.tree_contributions(df, model, path, key=KEY)
    margin = model.transform(df).select(KEY, vector_to_array(F.col("rawPrediction"))[1].alias("margin"))
    return given.join(margin, KEY)


def stationarity(model, train: DataFrame, n_features: int) -> DataFrame:
    """Per coefficient (and the intercept, position -1): the objective's
    gradient at the fitted coefficients, in units of the feature's spread."""
    n = train.count()
    reg = 1.0 / (LOGREG_C * n)
    beta = model.coefficients.toArray().tolist()
    rows = probability(model.transform(train.withColumn("w", balanced_weight(train))))
    x = vector_to_array(F.col("features"))
    wt, err = F.sum("w"), F.col("w") * (F.col("churn_probability") - F.col(LABEL))
    one = rows.agg(
        (F.sum(err) / wt).alias("g_1"),
        *[((F.sum(err * x[i]) / wt + reg * beta[i]) / F.greatest(F.stddev_pop(x[i]), F.lit(1e-9)))
          .alias(f"g{i}") for i in range(n_features)])
    return one.select(F.explode(F.array(
        F.struct(F.lit(-1).alias("position"), F.col("g_1").alias("gradient")),
        *[F.struct(F.lit(i).alias("position"), F.col(f"g{i}").alias("gradient"))
          for i in range(n_features)])).alias("r")).select("r.*")


def linear_gap(model, df: DataFrame) -> float:
    """The largest difference, over the rows of ``df``, between the intercept
    plus the features' contributions and the model's margin; infinite for a
    model that gives all rows one margin."""
    coefs = F.array(*map(F.lit, model.coefficients.toArray().tolist()))
    parts = F.zip_with(coefs, vector_to_array(F.col("features")), lambda c, x: c * x)
    total = F.aggregate(parts, F.lit(float(model.intercept)), lambda s, x: s + x)
    margin = vector_to_array(F.col("rawPrediction"))[1]
    r = model.transform(df).agg(F.max(F.abs(total - margin)).alias("off"),
                                (F.max(margin) - F.min(margin)).alias("spread")).first()
    return r["off"] if r["spread"] else float("inf")


def linear_contributions(model, df: DataFrame, features: list[str]) -> DataFrame:
    """Mean |coef_j * (x_j - mean_j)| per feature over all rows of ``df``: the
    exact per-feature contribution to the logit of a linear model. Two
    aggregate passes (means, then contributions); no row leaves the cluster."""
    coefs = model.coefficients.toArray().tolist()
    x = vector_to_array(F.col("features"))
    arr = df.select(x.alias("x"))
    means = arr.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(features))])
    m = [means.select(f"m{i}").scalar() for i in range(len(features))]
    contrib = arr.agg(*[F.avg(F.abs(F.lit(coefs[i]) * (F.col("x")[i] - m[i]))).alias(f"c{i}")
                        for i in range(len(features))])
    return contrib.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("importance"))
        for i, f in enumerate(features)])).alias("r")).select("r.*")
