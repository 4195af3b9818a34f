"""Classification metrics from one confusion-count aggregate.

All five scores come from ``tp, fp, fn, tn`` (positive class = 1), computed
with ``count_if`` in a single partial/final aggregate, optionally per group
(e.g. per model).  Undefined ratios follow scikit-learn's ``zero_division``
default (0); kappa and ROC-AUC are NULL where scikit-learn gives NaN / raises.
ROC-AUC here is computed from hard labels, as the reference does, which
equals balanced accuracy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.stats import safe_div

SCORE_COLUMNS = ["f1_score", "precision_score", "recall_score", "cohen_kappa_score", "roc_auc_score"]


def confusion_counts(df: DataFrame, y_true: str, y_pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    t = F.col(y_true).cast("int")
    p = F.col(y_pred).cast("int")
    aggs = [
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    ]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def score_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    n = tp + fp + fn + tn
    f1 = safe_div(2 * tp, 2 * tp + fp + fn)
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    # kappa = 1 - observed disagreement / disagreement expected from the margins
    expected_off = F.try_divide((tp + fn) * (tn + fn) + (tn + fp) * (tp + fp), n)
    kappa = F.lit(1.0) - F.try_divide(fp + fn, expected_off)
    tpr = F.try_divide(tp, tp + fn)
    tnr = F.try_divide(tn, tn + fp)
    auc = (tpr + tnr) / F.lit(2.0)
    return [
        f1.alias("f1_score"),
        precision.alias("precision_score"),
        recall.alias("recall_score"),
        kappa.alias("cohen_kappa_score"),
        auc.alias("roc_auc_score"),
    ]


def classification_scores(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    group_cols: Sequence[str] = (),
    with_counts: bool = True,
    timestamp: Column | None = None,
) -> DataFrame:
    """One row (per group) of ``tp, fp, fn, tn`` and the five scores.

    ``timestamp`` adds the epoch-seconds stamp the reference stores with the
    scores (pass ``F.unix_timestamp()`` for "now").
    """
    cc = confusion_counts(df, y_true, y_pred, group_cols)
    cols = [F.col(g) for g in group_cols]
    if timestamp is not None:
        cols.append(timestamp.cast("long").alias("timestamp"))
    if with_counts:
        cols += [F.col(c) for c in ("tp", "fp", "fn", "tn")]
    cols += score_columns(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return cc.select(*cols)


def rounded_scores(scores: DataFrame, digits: int = 3) -> DataFrame:
    """Scores rounded for storage (the metrics-history format)."""
    return scores.select(
        *[F.round(F.col(c), digits).alias(c) if c in SCORE_COLUMNS else F.col(c) for c in scores.columns]
    )


def row_count(df: DataFrame) -> int:
    return df.count()
