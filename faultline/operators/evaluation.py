"""Model gates and champion/challenger comparison on prediction columns.

All of it is one confusion-count aggregate (per split or per model) plus a
projection; nothing is collected except the one-row verdict when a caller
asks to raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.metrics import SCORE_COLUMNS, classification_scores, score_columns

# --- Fixed values: acceptance thresholds used by the reference. ---------------
MIN_TRAIN_F1 = 0.6
MIN_TRAIN_ROC_AUC = 0.7
MAX_F1_GAP = 0.05
CHANGE_THRESHOLD = 0.02
# ------------------------------------------------------------------------------


def adequacy_gates(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    split_col: str = "split",
    min_f1: float = MIN_TRAIN_F1,
    min_roc_auc: float = MIN_TRAIN_ROC_AUC,
    max_gap: float = MAX_F1_GAP,
) -> DataFrame:
    """One row: train/test F1 and ROC-AUC, the adequacy gate (train F1 >
    ``min_f1`` and train ROC-AUC > ``min_roc_auc``), the fit gate
    (``|F1_train - F1_test| <= max_gap``) and ``passed``."""
    s = classification_scores(df, y_true, y_pred, group_cols=[split_col], with_counts=False)
    wide = s.agg(
        *[
            F.max(F.when(F.col(split_col) == side, F.col(m))).alias(f"{side}_{m}")
            for side in ("train", "test")
            for m in ("f1_score", "roc_auc_score")
        ]
    )
    adequate = (F.col("train_f1_score") > min_f1) & (F.col("train_roc_auc_score") > min_roc_auc)
    gap = F.abs(F.col("train_f1_score") - F.col("test_f1_score"))
    fit_ok = gap <= max_gap
    return wide.select(
        "*",
        gap.alias("f1_gap"),
        F.coalesce(adequate, F.lit(False)).alias("adequate"),
        F.coalesce(fit_ok, F.lit(False)).alias("fit_ok"),
        F.coalesce(adequate & fit_ok, F.lit(False)).alias("passed"),
    )


class GateError(Exception):
    pass


def assert_gates(gates: DataFrame) -> None:
    row = gates.first()
    if not row["adequate"]:
        raise GateError("trained model performance is inadequate")
    if not row["fit_ok"]:
        raise GateError("trained model over- or under-fits (train/test F1 gap too large)")


def compare_models(
    df: DataFrame,
    y_true: str,
    trained_pred: str,
    best_pred: str | None = None,
    threshold: float = CHANGE_THRESHOLD,
) -> DataFrame:
    """Champion/challenger verdict in one row.

    Scores of the trained model (``trained_*``) and of the current best
    (``best_*``) on the same rows, ``improved_f1_score``,
    ``improved_roc_auc_score`` and ``is_model_accepted`` (either improvement
    above ``threshold``).  Without a current best the trained model is
    accepted and the deltas are NULL.
    """
    t = F.col(y_true).cast("int")

    def counts(p: str, prefix: str):
        pc = F.col(p).cast("int")
        return [
            F.count_if((t == 1) & (pc == 1)).alias(f"{prefix}tp"),
            F.count_if((t == 0) & (pc == 1)).alias(f"{prefix}fp"),
            F.count_if((t == 1) & (pc == 0)).alias(f"{prefix}fn"),
            F.count_if((t == 0) & (pc == 0)).alias(f"{prefix}tn"),
        ]

    aggs = counts(trained_pred, "t_") + (counts(best_pred, "b_") if best_pred else [])
    c = df.agg(*aggs)

    def scores(prefix: str, out: str):
        cols = score_columns(*(F.col(f"{prefix}{x}") for x in ("tp", "fp", "fn", "tn")))
        return [col.alias(f"{out}_{name}") for col, name in zip(cols, SCORE_COLUMNS)]

    trained = scores("t_", "trained")
    if best_pred is None:
        best = [F.lit(None).cast("double").alias(f"best_{n}") for n in SCORE_COLUMNS]
        out = c.select(*trained, *best)
        return out.select(
            "*",
            F.lit(None).cast("double").alias("improved_f1_score"),
            F.lit(None).cast("double").alias("improved_roc_auc_score"),
            F.lit(True).alias("is_model_accepted"),
        )
    out = c.select(*trained, *scores("b_", "best"))
    d_f1 = F.col("trained_f1_score") - F.col("best_f1_score")
    d_roc = F.col("trained_roc_auc_score") - F.col("best_roc_auc_score")
    return out.select(
        "*",
        d_f1.alias("improved_f1_score"),
        d_roc.alias("improved_roc_auc_score"),
        F.coalesce((d_f1 > threshold) | (d_roc > threshold), F.lit(False)).alias("is_model_accepted"),
    )
