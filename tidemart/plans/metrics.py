"""Exact binary-classification metrics over a (label, score) DataFrame.

Scores are first grouped (one row per distinct score with its positive and
negative counts, a partial aggregation), then running totals in descending
score order come from the distributed prefix sum in ``operators.scale``; no
step collects scores to the driver or into one task. Counts stay integral
until the final division, so the results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import row_numbers

EPS_F1 = 1e-9  # fixed value: the epsilon in F1 = 2pr / (p + r + eps)
CLASS_NAMES = {0: "Active", 1: "Churned"}  # fixed values: report labels


def score_groups(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))


def curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score t: tp, fp = positives / negatives with score >= t."""
    g = score_groups(df, label, score)
    c = row_numbers(g, [F.col("score").desc()], weight_cols=["pos", "neg"], out="_rank")
    return c.select("score", "pos", "neg", F.col("cum_pos").alias("tp"),
                    F.col("cum_neg").alias("fp"))


def _totals(df: DataFrame, label: str) -> tuple[Column, Column]:
    t = df.agg(F.sum(F.col(label).cast("long")).alias("P"),
               F.sum((1 - F.col(label)).cast("long")).alias("N"))
    return t.select("P").scalar(), t.select("N").scalar()


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC; tied scores across classes get half credit."""
    c = curve(df, label, score)
    P, N = _totals(df, label)
    # sum over scores of neg_s * (2 * positives strictly above + pos_s), exact
    term = (F.col("neg").cast("decimal(38,0)")
            * (2 * (F.col("tp") - F.col("pos")) + F.col("pos")).cast("decimal(38,0)"))
    s = c.agg(F.sum(term).alias("u2"))
    return s.select((F.col("u2").cast("double") / (2.0 * P.cast("double") * N.cast("double")))
                    .alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c = curve(df, label, score)
    P, N = _totals(df, label)
    return c.select(F.col("score").alias("threshold"),
                    (F.col("fp").cast("double") / N.cast("double")).alias("fpr"),
                    (F.col("tp").cast("double") / P.cast("double")).alias("tpr"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall and F1 when predicting positive for score >= threshold."""
    c = curve(df, label, score)
    P, _ = _totals(df, label)
    n_all = df.agg(F.count(F.lit(1))).scalar()
    prec = F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    rec = F.col("tp").cast("double") / P.cast("double")
    out = c.select(F.col("score").alias("threshold"), prec.alias("precision"),
                   rec.alias("recall"),
                   (P.cast("double") / n_all.cast("double")).alias("positive_rate"))
    return out.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def f1(p: Column, r: Column) -> Column:
    return F.lit(2.0) * p * r / (p + r + F.lit(EPS_F1))


def best_threshold(pr: DataFrame) -> DataFrame:
    """Arg-max F1; on ties the smallest threshold (first in ascending order)."""
    return pr.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def apply_threshold(df: DataFrame, t: Column, score: str = "score",
                    out: str = "prediction") -> DataFrame:
    return df.withColumn(out, (F.col(score) >= t).cast("int"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """All four cells (actual, predicted, count), zeros included, in one pass."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    agg = df.agg(*[F.count_if((F.col(label) == a) & (F.col(pred) == p)).alias(f"c{a}{p}")
                   for a, p in cells])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                 F.col(f"c{a}{p}").alias("count")) for a, p in cells])).alias("r")).select("r.*")


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def class_scores(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 (no epsilon; 0 when undefined), support."""
    cm = df.agg(*[F.count_if((F.col(label) == a) & (F.col(pred) == p)).alias(f"c{a}{p}")
                  for a in (0, 1) for p in (0, 1)])
    rows = []
    for k in (0, 1):
        o = 1 - k
        tp, fp, fn = F.col(f"c{k}{k}"), F.col(f"c{o}{k}"), F.col(f"c{k}{o}")
        p, r = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
        rows.append(F.struct(F.lit(k).alias("class"), F.lit(CLASS_NAMES[k]).alias("name"),
                             p.alias("precision"), r.alias("recall"),
                             F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
                              .alias("f1"),
                             (tp + fn).alias("support")))
    return cm.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def classification_report(df: DataFrame, label: str = "label",
                          pred: str = "prediction") -> DataFrame:
    """Rows Active, Churned, accuracy, macro avg, weighted avg (sklearn layout)."""
    cs = class_scores(df, label, pred)
    acc = df.agg(_safe_div(F.count_if(F.col(label) == F.col(pred)), F.count(F.lit(1)))
                 .alias("f1"), F.count(F.lit(1)).alias("support"))
    per = cs.select("name", "precision", "recall", "f1", "support")
    total = F.sum("support")
    avgs = cs.agg(
        F.struct(F.lit("macro avg").alias("name"), (F.sum("precision") / 2).alias("precision"),
                 (F.sum("recall") / 2).alias("recall"), (F.sum("f1") / 2).alias("f1"),
                 total.alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("name"),
                 (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
                 (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
                 (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"),
                 total.alias("support")).alias("w"))
    acc_row = acc.select(F.lit("accuracy").alias("name"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), "f1", "support")
    return (per.unionByName(acc_row)
               .unionByName(avgs.select("m.*"))
               .unionByName(avgs.select("w.*")))


def active_precision_recall(df: DataFrame, label: str = "label",
                            pred: str = "prediction") -> DataFrame:
    """Precision, recall and F1 (with epsilon) of the minority class 0."""
    c = df.agg(F.count_if((F.col(label) == 0) & (F.col(pred) == 0)).alias("tp"),
               F.count_if((F.col(label) == 1) & (F.col(pred) == 0)).alias("fp"),
               F.count_if((F.col(label) == 0) & (F.col(pred) == 1)).alias("fn"))
    p = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(p.alias("precision"), r.alias("recall")) \
            .withColumn("f1", f1(F.col("precision"), F.col("recall")))
