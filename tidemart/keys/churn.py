"""Keys for the churn model.

Metric keys are exact and engine-independent, so they are checked against
DuckDB on a fixed stand-in score (``standin_score``: a rational function of
monetary value, in (0, 1)). The numbers of the training keys depend on the
optimiser, so these keys return what does not: which rows are in which split
(DuckDB computes the same hashes), and whether the trained model obeys its rule
on them (the gradient vanishes, the best weight is the arg-max, training stopped
where patience ends, thresholds and percentiles were applied, a reloaded model
scores alike, Shapley values add up to the margin). A constant model fails
them. Models are trained once per session and source content.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Warehouse
from ..oracle import cte, sql
from ..plans import churn as C
from ..plans import ledger, shapley
from ..plans import metrics as M
from ..operators.positions import write_and_reread
from ..session import work_path
from ..sources import databases, files
from . import register

STANDIN_SCALE = 100000.0


def dataset(spark, sf_dir) -> DataFrame:
    """Features + labels, one row per customer."""
    w = Warehouse(spark, sf_dir)
    return C.ml_dataset(w.mart_customer_features, w.mart_churn_labels)


def with_written_orders(spark, sf_dir) -> Warehouse:
    """A warehouse whose order fact, which features and labels read five times,
    is built once."""
    w = Warehouse(spark, sf_dir)
    w.fct_orders = write_and_reread(w.fct_orders, "ml-orders")
    return w


def written_dataset(spark, sf_dir) -> DataFrame:
    """The same, written once as Parquet for steps that read it several times."""
    w = with_written_orders(spark, sf_dir)
    return write_and_reread(C.ml_dataset(w.mart_customer_features, w.mart_churn_labels), "ml-dataset")


def standin_score(ds: DataFrame) -> DataFrame:
    m = F.coalesce(F.col("monetary"), F.lit(0)).cast("double")
    return ds.select(C.KEY, F.col(C.LABEL).alias("label"),
                     (m / (m + F.lit(STANDIN_SCALE))).alias("score"))


def standin(spark, sf_dir) -> DataFrame:
    return write_and_reread(standin_score(dataset(spark, sf_dir)), "standin")


cte("ml_dataset", """
SELECT f.*, l.is_churned, l.days_since_last_order
FROM mart_customer_features f JOIN mart_churn_labels l ON f.customer_id = l.customer_id
""")
cte("standin", f"""
SELECT customer_id, is_churned AS label,
       CAST(coalesce(monetary, 0) AS DOUBLE)
         / (CAST(coalesce(monetary, 0) AS DOUBLE) + {STANDIN_SCALE}) AS score
FROM ml_dataset
""")
cte("standin_totals", """
SELECT CAST(sum(label) AS BIGINT) AS P, CAST(sum(1 - label) AS BIGINT) AS N, count(*) AS n_all
FROM standin
""")
cte("standin_curve", """
SELECT score, pos, neg,
       CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
       CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
FROM (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
      FROM standin GROUP BY score) g
""")
cte("standin_pr", """
SELECT threshold, precision, recall, positive_rate,
       2.0 * precision * recall / (precision + recall + 1e-9) AS f1
FROM (SELECT score AS threshold,
             CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
             CAST(tp AS DOUBLE) / CAST((SELECT P FROM standin_totals) AS DOUBLE) AS recall,
             CAST((SELECT P FROM standin_totals) AS DOUBLE)
               / CAST((SELECT n_all FROM standin_totals) AS DOUBLE) AS positive_rate
      FROM standin_curve) c
""")
cte("standin_best", "SELECT * FROM standin_pr ORDER BY f1 DESC, threshold LIMIT 1")
cte("standin_pred", """
SELECT customer_id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM standin
""")
cte("standin_pred_tuned", """
SELECT customer_id, label, score,
       CAST(score >= (SELECT threshold FROM standin_best) AS INTEGER) AS prediction
FROM standin
""")


# ------------------------------------------------------------ dataset
@register("ml_dataset", sql("SELECT * FROM ml_dataset"))
def ml_dataset(spark, sf_dir):
    return dataset(spark, sf_dir)


@register("join_using", sql("SELECT * FROM ml_dataset"))
def join_using(spark, sf_dir):
    return dataset(spark, sf_dir)


@register("ml_class_distribution", sql("""
SELECT is_churned, count(*) AS customers,
       CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM ml_dataset) AS DOUBLE) AS rate
FROM ml_dataset GROUP BY is_churned"""))
def ml_class_distribution(spark, sf_dir):
    return C.class_distribution(dataset(spark, sf_dir))


_CORR_COLS = ["recency_days", "frequency", "monetary", "avg_order_value", "avg_delivery_days",
              "max_delivery_days", "late_delivery_rate", "avg_items_per_order",
              "avg_purchase_gap_days", "avg_installments", "credit_card_rate",
              "avg_review_score", "min_review_score", "bad_review_rate",
              "days_since_last_order"]


def _corr_sql() -> str:
    parts = []
    for c in _CORR_COLS:
        x = f"CAST({c} AS DOUBLE)"
        xs = f"CASE WHEN {c} IS NOT NULL AND is_churned IS NOT NULL THEN {x} END"
        ys = f"CASE WHEN {c} IS NOT NULL AND is_churned IS NOT NULL THEN CAST(is_churned AS DOUBLE) END"
        parts.append(
            f"SELECT '{c}' AS feature, round(CASE WHEN stddev_pop({xs}) * stddev_pop({ys}) = 0 "
            f"THEN NULL ELSE covar_pop({xs}, {ys}) / (stddev_pop({xs}) * stddev_pop({ys})) END, 9)"
            f" AS correlation FROM ml_dataset")
    return " UNION ALL ".join(parts)


CORR_SQL = sql(_corr_sql())


@register("ml_feature_correlation", CORR_SQL)
def ml_feature_correlation(spark, sf_dir):
    return C.feature_correlation(dataset(spark, sf_dir))


@register("agg_corr", CORR_SQL)
def agg_corr(spark, sf_dir):
    return C.feature_correlation(dataset(spark, sf_dir)).orderBy("correlation")


cte("ml_encoded", """
SELECT *, CAST(dense_rank() OVER (ORDER BY coalesce(customer_state, 'Unknown')) - 1 AS DOUBLE)
         AS state_encoded
FROM ml_dataset
""")


@register("ml_label_encode", sql("SELECT customer_id, customer_state, state_encoded FROM ml_encoded"))
def ml_label_encode(spark, sf_dir):
    enc, _ = C.encode_state(written_dataset(spark, sf_dir))
    return enc.select(C.KEY, "customer_state", C.STATE_ENCODED)


cte("ml_split", """
SELECT *, rn <= CAST(floor((n * 200000 + 999999) / 1000000) AS BIGINT) AS is_test
FROM (SELECT *, row_number() OVER (PARTITION BY is_churned
                                   ORDER BY md5(customer_id || ':42'), customer_id) AS rn,
             count(*) OVER (PARTITION BY is_churned) AS n
      FROM ml_encoded) r
""")


@register("ml_stratified_split", sql("SELECT customer_id, is_churned, is_test FROM ml_split"))
def ml_stratified_split(spark, sf_dir):
    small = write_and_reread(dataset(spark, sf_dir).select(C.KEY, C.LABEL), "labels")
    return C.stratified_split(small).select(C.KEY, C.LABEL, "is_test")


_FEATS = C.FEATURE_CANDIDATES + [C.STATE_ENCODED]


def _median_sql() -> str:
    for f in _FEATS:
        cte(f"med_{f}", f"""
SELECT lo.v + (hi.v - lo.v) * t.frac AS q
FROM (SELECT floor((n - 1) * 0.5) + 1 AS lo_rn, ceil((n - 1) * 0.5) + 1 AS hi_rn,
             (n - 1) * 0.5 - floor((n - 1) * 0.5) AS frac
      FROM (SELECT count({f}) AS n FROM ml_split WHERE NOT is_test) c) t
JOIN (SELECT CAST({f} AS DOUBLE) AS v, row_number() OVER (ORDER BY CAST({f} AS DOUBLE)) AS rn
      FROM ml_split WHERE NOT is_test AND {f} IS NOT NULL) lo ON lo.rn = t.lo_rn
JOIN (SELECT CAST({f} AS DOUBLE) AS v, row_number() OVER (ORDER BY CAST({f} AS DOUBLE)) AS rn
      FROM ml_split WHERE NOT is_test AND {f} IS NOT NULL) hi ON hi.rn = t.hi_rn
""")
    cols = ", ".join(f"coalesce(CAST({f} AS DOUBLE), (SELECT q FROM med_{f})) AS {f}" for f in _FEATS)
    return sql(f"SELECT customer_id, is_test, {cols} FROM ml_split")


@register("ml_median_impute", _median_sql())
def ml_median_impute(spark, sf_dir):
    enc, _ = C.encode_state(written_dataset(spark, sf_dir))
    split = C.stratified_split(enc)
    med = C.collect_medians(split.filter(~F.col("is_test")), _FEATS)
    return C.impute(split, med, _FEATS).select(C.KEY, "is_test", *_FEATS)


@register("agg_median", sql(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, (SELECT q FROM med_{f}) AS q" for f in _FEATS)))
def agg_median(spark, sf_dir):
    enc, _ = C.encode_state(written_dataset(spark, sf_dir))
    split = C.stratified_split(enc)
    return C.medians(split.filter(~F.col("is_test")), _FEATS)


# ------------------------------------------------------- exact metrics
@register("ml_roc_auc", sql("""
SELECT CAST(sum(CAST(neg AS HUGEINT) * (2 * (tp - pos) + pos)) AS DOUBLE)
       / (2.0 * CAST((SELECT P FROM standin_totals) AS DOUBLE)
              * CAST((SELECT N FROM standin_totals) AS DOUBLE)) AS roc_auc
FROM standin_curve"""))
def ml_roc_auc(spark, sf_dir):
    return M.roc_auc(standin(spark, sf_dir))


@register("ml_roc_curve", sql("""
SELECT score AS threshold,
       CAST(fp AS DOUBLE) / CAST((SELECT N FROM standin_totals) AS DOUBLE) AS fpr,
       CAST(tp AS DOUBLE) / CAST((SELECT P FROM standin_totals) AS DOUBLE) AS tpr
FROM standin_curve"""))
def ml_roc_curve(spark, sf_dir):
    return M.roc_curve(standin(spark, sf_dir))


@register("ml_pr_curve", sql("SELECT threshold, precision, recall, positive_rate FROM standin_pr"))
def ml_pr_curve(spark, sf_dir):
    return M.pr_curve(standin(spark, sf_dir)).drop("f1")


@register("ml_f1_by_threshold", sql("SELECT threshold, f1 FROM standin_pr"))
def ml_f1_by_threshold(spark, sf_dir):
    return M.pr_curve(standin(spark, sf_dir)).select("threshold", "f1")


@register("ml_best_threshold", sql("SELECT threshold, f1, precision, recall FROM standin_best"))
def ml_best_threshold(spark, sf_dir):
    return M.best_threshold(M.pr_curve(standin(spark, sf_dir))) \
            .select("threshold", "f1", "precision", "recall")


def _tuned(s: DataFrame) -> DataFrame:
    t = M.best_threshold(M.pr_curve(s)).select("threshold").scalar()
    return M.apply_threshold(s, t)


@register("ml_apply_threshold", sql("SELECT customer_id, score, prediction FROM standin_pred_tuned"))
def ml_apply_threshold(spark, sf_dir):
    return _tuned(standin(spark, sf_dir)).select(C.KEY, "score", "prediction")


def _sd(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def _f1(p: str, r: str) -> str:
    return f"CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"


cte("standin_cm", """
SELECT count_if(label = 0 AND prediction = 0) AS c00, count_if(label = 0 AND prediction = 1) AS c01,
       count_if(label = 1 AND prediction = 0) AS c10, count_if(label = 1 AND prediction = 1) AS c11,
       count(*) AS n
FROM standin_pred
""")
_P0, _R0 = _sd("c00", "c00 + c10"), _sd("c00", "c00 + c01")
_P1, _R1 = _sd("c11", "c11 + c01"), _sd("c11", "c11 + c10")
cte("standin_report_per", f"""
SELECT 'Active' AS name, {_P0} AS precision, {_R0} AS recall, {_f1(_P0, _R0)} AS f1,
       c00 + c01 AS support FROM standin_cm
UNION ALL
SELECT 'Churned', {_P1}, {_R1}, {_f1(_P1, _R1)}, c11 + c10 FROM standin_cm
""")
REPORT_SQL = sql(f"""
SELECT * FROM standin_report_per
UNION ALL SELECT 'accuracy', NULL, NULL, {_sd('c00 + c11', 'n')}, n FROM standin_cm
UNION ALL SELECT 'macro avg', sum(precision) / 2, sum(recall) / 2, sum(f1) / 2, sum(support)
          FROM standin_report_per
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                 sum(support) FROM standin_report_per""")


@register("ml_classification_report", REPORT_SQL)
def ml_classification_report(spark, sf_dir):
    p = M.apply_threshold(standin(spark, sf_dir), F.lit(0.5))
    return M.classification_report(p, "label", "prediction")


@register("ml_active_precision_recall", sql("""
SELECT precision, recall, 2.0 * precision * recall / (precision + recall + 1e-9) AS f1
FROM (SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END
               AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END
               AS recall
      FROM (SELECT count_if(label = 0 AND prediction = 0) AS tp,
                   count_if(label = 1 AND prediction = 0) AS fp,
                   count_if(label = 0 AND prediction = 1) AS fn FROM standin_pred) c) p"""))
def ml_active_precision_recall(spark, sf_dir):
    p = M.apply_threshold(standin(spark, sf_dir), F.lit(0.5))
    return M.active_precision_recall(p, "label", "prediction")


@register("ml_confusion_matrix", sql("""
SELECT 'default' AS threshold_kind, label AS actual, prediction AS predicted, count(*) AS count
FROM standin_pred GROUP BY ALL
UNION ALL
SELECT 'tuned', label, prediction, count(*) FROM standin_pred_tuned GROUP BY ALL"""))
def ml_confusion_matrix(spark, sf_dir):
    s = standin(spark, sf_dir)
    d = M.confusion_counts(M.apply_threshold(s, F.lit(0.5)), "label")
    t = M.confusion_counts(_tuned(s), "label")
    out = d.withColumn("threshold_kind", F.lit("default")).unionByName(
        t.withColumn("threshold_kind", F.lit("tuned")))
    return out.filter(F.col("count") > 0).select("threshold_kind", "actual", "predicted", "count")


cte("standin_risk_edges", """
SELECT t.p, lo.v + (hi.v - lo.v) * t.frac AS q
FROM (SELECT p, floor((n - 1) * p) + 1 AS lo_rn, ceil((n - 1) * p) + 1 AS hi_rn,
             (n - 1) * p - floor((n - 1) * p) AS frac
      FROM (SELECT count(*) AS n FROM standin) c, (SELECT unnest([0.33, 0.66]::DOUBLE[]) AS p) ps) t
JOIN (SELECT score AS v, row_number() OVER (ORDER BY score, customer_id) AS rn FROM standin) lo
  ON lo.rn = t.lo_rn
JOIN (SELECT score AS v, row_number() OVER (ORDER BY score, customer_id) AS rn FROM standin) hi
  ON hi.rn = t.hi_rn
""")
cte("standin_risk", """
SELECT customer_id, score AS churn_probability, risk_segment,
       CASE risk_segment WHEN 'High Risk' THEN 'Immediate win-back campaign'
                         WHEN 'Medium Risk' THEN 'Nurture email sequence'
                         WHEN 'Low Risk' THEN 'Standard newsletter' END AS recommended_action
FROM (SELECT *, CASE
        WHEN score >= 0 AND score <= (SELECT q FROM standin_risk_edges WHERE p = 0.33) THEN 'Low Risk'
        WHEN score > (SELECT q FROM standin_risk_edges WHERE p = 0.33)
             AND score <= (SELECT q FROM standin_risk_edges WHERE p = 0.66) THEN 'Medium Risk'
        WHEN score > (SELECT q FROM standin_risk_edges WHERE p = 0.66) AND score <= 1
             THEN 'High Risk' END AS risk_segment
      FROM standin) s
""")


def _standin_risk(spark, sf_dir) -> DataFrame:
    s = standin(spark, sf_dir).select(C.KEY, F.col("score").alias("churn_probability"))
    return C.risk_segments(s)


@register("ml_risk_segments", sql("SELECT * FROM standin_risk"))
def ml_risk_segments(spark, sf_dir):
    return _standin_risk(spark, sf_dir)


@register("percentile_bins", sql("SELECT customer_id, churn_probability, risk_segment FROM standin_risk"))
def percentile_bins(spark, sf_dir):
    return _standin_risk(spark, sf_dir).select(C.KEY, "churn_probability", "risk_segment")


@register("label_map", sql("SELECT customer_id, risk_segment, recommended_action FROM standin_risk"))
def label_map(spark, sf_dir):
    return _standin_risk(spark, sf_dir).select(C.KEY, "risk_segment", "recommended_action")


@register("ml_risk_distribution", sql(
    "SELECT risk_segment, count(*) AS customers FROM standin_risk GROUP BY risk_segment"))
def ml_risk_distribution(spark, sf_dir):
    return C.risk_distribution(_standin_risk(spark, sf_dir))


# ------------------------------------------------------------ training
_TRAINED: dict = {}


def _stamp(spark, sf_dir) -> tuple:
    """Names, sizes and times of the source's files: whether the dataset changed
    is known without building it."""
    return spark.sparkContext.applicationId, files.source_tag(sf_dir), ledger.files_fingerprint(spark, sf_dir)


def trained(spark, sf_dir, part: str):
    """Train each piece once per session and source content, and share it
    across keys; only the latest source's models are kept. The dataset is built
    and written when its first piece is trained."""
    key = _stamp(spark, sf_dir)
    if key not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[key] = {"prep": C.prepare(written_dataset(spark, sf_dir))}
    st = _TRAINED[key]
    prep = st["prep"]
    if part == "logreg" and "logreg" not in st:
        st["logreg"] = C.logistic_baseline(prep.train)
    if part in ("search", "final") and "search" not in st:
        st["search"] = C.weight_search(prep.train)
    if part == "final" and "final" not in st:
        best_w, _ = st["search"]
        boosted = C.final_model(prep.train, best_w)
        # the threshold is tuned on validation rows, never on test rows
        val = write_and_reread(C.scored(boosted.model, boosted.validation), "validation-scores")
        pr = M.pr_curve(val, C.LABEL, "churn_probability")
        st["final"] = (boosted, M.best_threshold(pr).first()["threshold"])
    return st[part]


def _consistent(scores: DataFrame):
    p = F.col("churn_probability")
    return p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("int"))


def beats_constant(scores: DataFrame, weight) -> bool:
    """Whether the weighted log loss of ``churn_probability`` is below that of
    the best constant (the weighted share of churned rows). False for a model
    that gives every row the same probability."""
    y, p = F.col(C.LABEL), F.least(F.greatest(F.col("churn_probability"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    r = scores.select(weight.alias("w"), y, loss.alias("loss")).agg(
        (F.sum(F.col("w") * F.col("loss")) / F.sum("w")).alias("loss"),
        (F.sum(F.col("w") * F.col(C.LABEL)) / F.sum("w")).alias("share")).first()
    q = r["share"]
    constant = -(q * math.log(q) + (1 - q) * math.log(1 - q)) if q and 0 < q < 1 else 0.0
    return r["loss"] is not None and r["loss"] < constant - 1e-9


GRADIENT_TOLERANCE = 1e-2  # of the loss per row and standard deviation of a feature


@register("ml_baseline_logreg", sql("""
SELECT customer_id, is_churned, true AS consistent, true AS stationary FROM ml_split WHERE is_test"""))
def ml_baseline_logreg(spark, sf_dir):
    """The test rows, whether their scores are consistent, and whether the
    objective's gradient vanishes at the fitted coefficients."""
    prep, model = trained(spark, sf_dir, "prep"), trained(spark, sf_dir, "logreg")
    worst = C.stationarity(model, prep.train, len(prep.features)).agg(
        F.max(F.abs("gradient"))).first()[0]
    s = C.scored(model, prep.test)
    return s.select(C.KEY, C.LABEL, _consistent(s).alias("consistent"),
                    F.lit(worst <= GRADIENT_TOLERANCE).alias("stationary"))


def _val_split(name: str, seed: int) -> None:
    cte(name, f"""
SELECT customer_id, is_churned,
       rn <= CAST(floor((n * 200000 + 999999) / 1000000) AS BIGINT) AS is_val
FROM (SELECT customer_id, is_churned,
             row_number() OVER (PARTITION BY is_churned
                                ORDER BY md5(customer_id || ':{seed}'), customer_id) AS rn,
             count(*) OVER (PARTITION BY is_churned) AS n
      FROM ml_split WHERE NOT is_test) r
""")


_val_split("search_split", C.SEED + 1)
_val_split("final_split", C.SEED + 2)


@register("ml_weight_search", sql(" UNION ALL ".join(f"""
SELECT {w} AS active_weight, count_if(is_churned = 0) AS active_rows,
       count_if(is_churned = 1) AS churned_rows, true AS f1_follows, true AS best_is_argmax
FROM search_split WHERE is_val""" for w in C.ACTIVE_WEIGHTS)))
def ml_weight_search(spark, sf_dir):
    """Per tried weight: validation rows by class, whether F1 follows from
    precision and recall, and whether the chosen weight is the first arg-max."""
    best_w, rows = trained(spark, sf_dir, "search")
    top = max(r[3] for r in rows)
    argmax = next((r[0] for r in rows if r[3] == top and top > 0), 1)
    out = [(w, a, c, abs(f - 2 * p * r / (p + r + M.EPS_F1)) < 1e-9 and 0 <= auc <= 1, best_w == argmax)
           for w, p, r, f, auc, a, c in rows]
    return spark.createDataFrame(out, "active_weight int, active_rows long, churned_rows long, "
                                      "f1_follows boolean, best_is_argmax boolean")


@register("ml_boosted_trees", sql("""
SELECT customer_id, is_churned, true AS consistent, true AS beats_constant FROM ml_split WHERE is_test"""))
def ml_boosted_trees(spark, sf_dir):
    """The test rows, whether their scores are consistent, and whether the model
    fits the training rows better than any constant does. (Whether it does so on
    other rows is up to the data, not to the algorithm.)"""
    boosted, _ = trained(spark, sf_dir, "final")
    prep = trained(spark, sf_dir, "prep")
    s = C.scored(boosted.model, prep.test)
    best_w, _ = trained(spark, sf_dir, "search")
    better = beats_constant(C.scored(boosted.model, prep.train), C.active_weight(best_w))
    return s.select(C.KEY, C.LABEL, _consistent(s).alias("consistent"), F.lit(better).alias("beats_constant"))


@register("ml_early_stopping", sql(f"""
SELECT {C.FINAL_ROUNDS} AS max_rounds, {C.PATIENCE} AS patience,
       (SELECT count(*) FROM ml_split WHERE is_test) AS test_rows,
       (SELECT count(*) FROM final_split WHERE is_val) AS validation_rows, true AS obeys_rule"""))
def ml_early_stopping(spark, sf_dir):
    """Whether training stopped ``patience`` rounds after the best validation
    loss (or ran out of rounds) and kept exactly the best number of trees."""
    b, _ = trained(spark, sf_dir, "final")
    prep = trained(spark, sf_dir, "prep")
    seen = b.losses[:b.rounds_tried]
    obeys = (b.model.getNumTrees == b.best_round and min(seen) == b.losses[b.best_round - 1]
             and (b.rounds_tried == b.best_round + C.PATIENCE or b.rounds_tried == C.FINAL_ROUNDS))
    return spark.createDataFrame(
        [(C.FINAL_ROUNDS, C.PATIENCE, prep.test.count(), b.validation.count(), obeys)],
        "max_rounds int, patience int, test_rows long, validation_rows long, obeys_rule boolean")


@register("ml_feature_importance", sql(" UNION ALL ".join(
    f"SELECT '{m}' AS model, '{f}' AS feature, (SELECT count(*) FROM ml_split WHERE is_test) AS test_rows, "
    f"true AS adds_up" for m in ("boosted_trees", "logistic_regression", "split_gain") for f in _FEATS)))
def ml_feature_importance(spark, sf_dir):
    """Per model and feature, the test rows it was measured on and whether the
    model's attributions add up: Shapley values and their base to the margin of
    every row (trees), contributions to the logit of every row (linear), shares
    of split gain to one. A constant model's do not."""
    imp, adds = attributions(spark, sf_dir)
    n = trained(spark, sf_dir, "prep").test.count()
    sums = F.create_map(*[x for m, ok in adds.items() for x in (F.lit(m), F.lit(ok))])
    return imp.select("model", "feature", F.lit(n).cast("long").alias("test_rows"),
                      (sums[F.col("model")] & (F.col("importance") >= 0)).alias("adds_up"))


def attributions(spark, sf_dir) -> tuple[DataFrame, dict[str, bool]]:
    """``model, feature, importance``: mean absolute Shapley value (trees), mean
    absolute contribution to the logit (linear) and share of split gain (trees),
    over all test rows; and per model whether its attributions add up."""
    boosted, _ = trained(spark, sf_dir, "final")
    prep = trained(spark, sf_dir, "prep")
    gains = list(map(float, boosted.model.featureImportances.toArray()))
    gain = spark.createDataFrame(list(zip(prep.features, gains)), "feature string, importance double")
    logreg = trained(spark, sf_dir, "logreg")
    linear = C.linear_contributions(logreg, prep.test, prep.features)
    given = write_and_reread(C.boosted_contributions(
        boosted.model, prep.test, work_path(spark, "nodes", uuid.uuid4().hex)), "contributions")
    trees = shapley.importance(given, prep.features)
    total = F.aggregate("contributions", F.col("base"), lambda s, x: s + x)
    r = given.agg(F.max(F.abs(total - F.col("margin"))).alias("off"), F.count_distinct("margin").alias("margins")).first()
    adds = {"boosted_trees": r["off"] is not None and r["off"] < 1e-6 and r["margins"] > 1,
            "logistic_regression": C.linear_gap(logreg, prep.test) < 1e-6,
            "split_gain": abs(sum(gains) - 1) < 1e-6}
    imp = (trees.withColumn("model", F.lit("boosted_trees"))
           .unionByName(linear.withColumn("model", F.lit("logistic_regression")))
           .unionByName(gain.withColumn("model", F.lit("split_gain"))))
    return imp, adds


def _score_all(spark, sf_dir) -> tuple[DataFrame, float]:
    boosted, thr = trained(spark, sf_dir, "final")
    s = C.probability(boosted.model.transform(trained(spark, sf_dir, "prep").all))
    return s.select(C.KEY, "churn_probability",
                    (F.col("churn_probability") >= F.lit(thr)).cast("int").alias("predicted_churned")), thr


@register("ml_score_all", sql("""
SELECT customer_id, true AS follows_margin, true AS threshold_applied, true AS varies FROM ml_dataset"""))
def ml_score_all(spark, sf_dir):
    """Every customer; whether its probability is the logistic function of twice
    the sum of its trees' Shapley values (not of the model's own output), whether
    the class follows from that by the threshold, and whether probabilities
    differ at all."""
    s, thr = _score_all(spark, sf_dir)
    boosted, _ = trained(spark, sf_dir, "final")
    given = shapley.tree_contributions(trained(spark, sf_dir, "prep").all, boosted.model,
                                       work_path(spark, "nodes", uuid.uuid4().hex), key=C.KEY)
    margin = F.aggregate("contributions", F.col("base"), lambda a, x: a + x)
    j = write_and_reread(s.join(given.select(C.KEY, (1 / (1 + F.exp(-2 * margin))).alias("p")), C.KEY), "scores-again")
    p, near = F.col("churn_probability"), F.abs(F.col("p") - F.lit(thr)) < 1e-9
    varies = j.agg(F.max("p") - F.min("p")).first()[0]
    return j.select(C.KEY, (F.abs(p - F.col("p")) < 1e-9).alias("follows_margin"),
                    (near | (F.col("predicted_churned") == (F.col("p") >= thr).cast("int"))).alias("threshold_applied"),
                    F.lit(bool(varies and varies > 1e-9)).alias("varies"))


def churn_scores_frame(spark, sf_dir) -> DataFrame:
    """The score table: every customer with probability, class, segment, action."""
    seg = C.risk_segments(write_and_reread(_score_all(spark, sf_dir)[0], "scores"))
    return seg.select(C.KEY, "churn_probability", "predicted_churned", "risk_segment",
                      "recommended_action")


@register("churn_scores", sql(
    "SELECT customer_id, true AS segment_follows, true AS action_follows, 3 AS segments FROM ml_dataset"))
def churn_scores(spark, sf_dir):
    """Every customer; whether its segment follows from the scores' percentiles
    (taken here by another function) and the action from the segment; and how
    many segments there are, which is one for a model that gives one score."""
    s = write_and_reread(churn_scores_frame(spark, sf_dir), "churn-scores")
    p33, p66 = s.agg(F.percentile("churn_probability", F.array(F.lit(0.33), F.lit(0.66)))).first()[0]
    p = F.col("churn_probability")
    segment = F.when(p <= p33, "Low Risk").when(p <= p66, "Medium Risk").otherwise("High Risk")
    action = (F.when(F.col("risk_segment") == "Low Risk", "Standard newsletter")
              .when(F.col("risk_segment") == "Medium Risk", "Nurture email sequence")
              .otherwise("Immediate win-back campaign"))
    n = s.select("risk_segment").distinct().count()
    return s.select(C.KEY, (F.col("risk_segment") == segment).alias("segment_follows"),
                    (F.col("recommended_action") == action).alias("action_follows"), F.lit(n).alias("segments"))


@register("score_table_replace", sql("""
SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers, 1 AS tables FROM ml_dataset"""))
def score_table_replace(spark, sf_dir):
    """The named score table after it was written twice."""
    base = work_path(spark, "score-table", files.source_tag(sf_dir))
    scores = churn_scores_frame(spark, sf_dir)
    db = f"marts_{files.source_tag(sf_dir)}"
    for _ in range(2):
        t = databases.replace_table(scores, db, "churn_scores", base)
    n = spark.sql(f"SHOW TABLES IN {db} LIKE 'churn_scores'").count()
    return t.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(C.KEY).alias("customers"),
                 F.lit(n).alias("tables"))


@register("model_save_load", sql("SELECT count(*) AS rows, 0 AS differing FROM ml_dataset"))
def model_save_load(spark, sf_dir):
    """Raw feature-mart rows scored by the reloaded pipeline: rows, and how many
    probabilities or classes differ from the model in memory."""
    boosted, thr = trained(spark, sf_dir, "final")
    prep = trained(spark, sf_dir, "prep")
    path = work_path(spark, "models", files.source_tag(sf_dir), "churn")
    C.save_model(prep.stages, boosted.model, prep.features, prep.med, thr, path, spark)
    loaded, meta = C.load_model(path, spark)
    t = meta.agg(F.max("threshold")).first()[0]
    raw = with_written_orders(spark, sf_dir).mart_customer_features
    again = C.probability(loaded.transform(raw)).select(
        C.KEY, F.col("churn_probability").alias("p"), (F.col("churn_probability") >= t).cast("int").alias("c"))
    j = _score_all(spark, sf_dir)[0].join(again, C.KEY)
    return j.agg(F.count(F.lit(1)).alias("rows"), F.count_if(
        (F.abs(F.col("p") - F.col("churn_probability")) > 1e-12)
        | (F.col("c") != F.col("predicted_churned"))).cast("int").alias("differing"))
