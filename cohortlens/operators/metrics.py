"""Exact classification metrics from scored rows (label 0/1, prediction 0/1, positive score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import half_up
from .ranking import running_totals

DIGITS = 4


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Complete 2x2 grid (label, prediction, n); empty cells are 0."""
    cells = [(y, p) for y in (0, 1) for p in (0, 1)]
    counts = scored.agg(
        *[F.count_if((F.col(label) == y) & (F.col(prediction) == p)).alias(f"n{y}{p}") for y, p in cells]
    )
    grid = ", ".join(f"{y}, {p}, n{y}{p}" for y, p in cells)
    return counts.selectExpr(f"stack({len(cells)}, {grid}) AS (label, prediction, n)")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where nothing was counted."""
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _cells(scored: DataFrame, label: str, prediction: str) -> tuple[DataFrame, Column, Column, Column, Column]:
    counts = scored.agg(
        *[
            F.count_if((F.col(label) == y) & (F.col(prediction) == p)).alias(name)
            for name, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        ]
    )
    return counts, F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")


def class_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and the positive class' precision, recall and F1, 4 decimals."""
    counts, tn, fp, fn, tp = _cells(scored, label, prediction)
    figures = {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
    }
    return counts.select(*[half_up(v, DIGITS).alias(n) for n, v in figures.items()])


def class_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    counts, tn, fp, fn, tp = _cells(scored, label, prediction)
    n0, n1 = tn + fp, tp + fn
    zero = (ratio(tn, tn + fn), ratio(tn, n0), ratio(2 * tn, 2 * tn + fp + fn))
    one = (ratio(tp, tp + fp), ratio(tp, n1), ratio(2 * tp, 2 * tp + fp + fn))
    accuracy = ratio(tp + tn, n0 + n1)
    lines = [
        ("0", *zero, n0),
        ("1", *one, n1),
        ("accuracy", accuracy, accuracy, accuracy, n0 + n1),
        ("macro avg", *[(a + b) / 2 for a, b in zip(zero, one)], n0 + n1),
        ("weighted avg", *[ratio(a * n0 + b * n1, n0 + n1) for a, b in zip(zero, one)], n0 + n1),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("class"),
            half_up(p, DIGITS).alias("precision"),
            half_up(r, DIGITS).alias("recall"),
            half_up(f, DIGITS).alias("f1_score"),
            support.alias("support"),
        )
        for name, p, r, f, support in lines
    ]
    return counts.select(F.inline(F.array(*rows)))


def score_counts(scored: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score; all later steps work on these."""
    return scored.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score", by: str | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest first, from (infinity, 0, 0).

    ``by`` names a model column; each of its values gets its own curve.
    """
    keys = [] if by is None else [by]
    totals = running_totals(score_counts(scored, label, score, keys), "threshold", ["pos", "neg"], keys, True)
    points = totals.select(
        *keys,
        "threshold",
        (F.col("cum_neg") / F.nullif("total_neg", F.lit(0))).alias("fpr"),
        (F.col("cum_pos") / F.nullif("total_pos", F.lit(0))).alias("tpr"),
    )
    # One start a curve, at its highest threshold: no other read of the scores.
    highest = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    starts = totals.where(highest).select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(starts)


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", by: str | None = None) -> DataFrame:
    """Exact area under the curve: the share of (positive, negative) pairs ranked right, ties half."""
    keys = [] if by is None else [by]
    totals = running_totals(score_counts(scored, label, score, keys), "threshold", ["pos", "neg"], keys, True)
    above = F.col("cum_pos") - F.col("pos") / 2
    pairs = F.max(F.col("total_pos").cast("double") * F.col("total_neg"))
    return totals.groupBy(*keys).agg((F.sum(F.col("neg") * above) / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def evaluate(scored: DataFrame, model: str, label: str = "label", score: str = "score") -> DataFrame:
    """One row per model: name, accuracy, precision, recall, F1 and ROC-AUC."""
    auc = roc_auc(scored, label, score).select(half_up(F.col("roc_auc"), DIGITS)).scalar()
    return class_metrics(scored, label).select(
        F.lit(model).alias("model"), "accuracy", "precision", "recall", "f1_score", auc.alias("roc_auc")
    )
