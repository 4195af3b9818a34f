"""Boosted-tree training with a seeded random search over a parameter grid.

The learner is ``boosting`` (second-order trees, default direction for missing values).  The
search draws ``n_iter`` grid points without replacement with a seeded generator (over the
tiny grid, on the driver).  Every candidate on every fold, and on all rows, is grown in the
same passes over the rows; all out-of-fold predictions are written as one table, and the
accuracies come from one aggregate over it.  Folds hold every class in equal parts.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.hashing import seeded_md5
from faultline.operators import boosting
from faultline.operators.boosting import BoostedTrees, Spec
from faultline.operators.ranking import hash_histogram, hash_rank_cut, histogram_counts
from faultline.operators.stages import BoostedTreesModel
from faultline.session import shared_table

# --- Fixed values: the reference's search space (XGBoost names). --------------
REFERENCE_GRID = {"learning_rate": [0.0136, 0.03], "max_depth": [7, 11], "n_estimators": [469, 877]}
# ------------------------------------------------------------------------------
# A grid that trains in seconds; use REFERENCE_GRID to match the reference's size.
SMALL_GRID = {"learning_rate": [0.1, 0.3], "max_depth": [3, 5], "n_estimators": [10, 20]}
FOLD_COL = "_fl_fold"


def sample_grid(grid: Mapping[str, Sequence], n_iter: int, seed: int = 1) -> list[dict]:
    """``n_iter`` distinct grid points, drawn without replacement (seeded)."""
    names = sorted(grid)
    points = [dict(zip(names, vals)) for vals in itertools.product(*(grid[n] for n in names))]
    rng = random.Random(seed)
    return rng.sample(points, min(n_iter, len(points)))


def stratified_folds(df: DataFrame, label_col: str, keys: Sequence[str], n_folds: int = 3, seed: int = 1) -> DataFrame:
    """Fold number per row, stratified by class: in ``md5(seed:key)`` order each class is
    cut into ``n_folds`` parts whose sizes differ by one row at most."""
    hashed = df.withColumn("_fl_h", seeded_md5(seed, *keys))
    hist = hash_histogram(hashed, label_col, "_fl_h")
    counts = histogram_counts(hist, label_col)
    fold = F.lit(0)
    for i in range(1, n_folds):
        quota = counts.select(label_col, F.floor(F.col("n_class") * i / n_folds).cast("long").alias("_fl_k"))
        hashed = hash_rank_cut(hashed, label_col, "_fl_h", list(keys), quota, out=f"_fl_upto{i}", hist=hist)
        fold = fold + F.when(F.col(f"_fl_upto{i}"), 0).otherwise(1)
    return hashed.select(*df.columns, fold.cast("int").alias(FOLD_COL))


@dataclass
class SearchResult:
    model: PipelineModel
    best_params: dict
    candidates: list[dict]
    cv_accuracy: list[float]
    out_of_fold: DataFrame  # keys, label, fold, candidate, prediction


def _pipeline(trees: BoostedTrees) -> PipelineModel:
    return PipelineModel([BoostedTreesModel(trees)])


def out_of_fold(data: DataFrame, keys: Sequence[str], label_col: str, models: Sequence[Sequence[BoostedTrees]]) -> DataFrame:
    """Each row scored by every candidate's model that has not seen the row's fold: keys, label, ``fold``,
    ``candidate``, ``prediction``.  One pass over the rows."""
    feats = models[0][0].features
    nan = F.lit(float("nan"))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in feats])
    n = len(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column("_fl_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(feats))
            fold = b.column(FOLD_COL).to_numpy()
            said = np.zeros((len(fold), n), dtype=np.int32)
            for i, own in enumerate(models):
                for k, model in enumerate(own):
                    at = np.flatnonzero(fold == k)
                    said[at, i] = model.margins(rows[at]) > 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(fold) + 1, dtype=np.int32) * n), pa.array(said.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], names=[*b.schema.names[:-1], "_fl_said"])

    narrow = data.select(*keys, label_col, FOLD_COL, x.alias("_fl_x"))
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("_fl_said", T.ArrayType(T.IntegerType()))])
    scored = narrow.mapInArrow(run, schema)
    return scored.select(
        *keys, label_col, F.col(FOLD_COL).alias("fold"), F.posexplode("_fl_said").alias("candidate", "prediction")
    )


def random_search(
    df: DataFrame,
    features: Sequence[str],
    label_col: str,
    keys: Sequence[str],
    grid: Mapping[str, Sequence] = SMALL_GRID,
    n_iter: int = 3,
    n_folds: int = 3,
    seed: int = 1,
) -> SearchResult:
    """Random search with cross-validated accuracy (mean of the folds' accuracies); the model
    is the best candidate's, grown on all rows.  Ties go to the candidate drawn first."""
    points = sample_grid(grid, n_iter, seed)
    data = stratified_folds(df.withColumn(label_col, F.col(label_col).cast("int")), label_col, keys, n_folds, seed)
    data = shared_table(data.select(*keys, *features, label_col, FOLD_COL), "folds")
    specs = [Spec(p, hold_out) for p in points for hold_out in (*range(n_folds), None)]
    grown = boosting.fit_many(data, features, label_col, specs, FOLD_COL)
    by_point = [grown[i : i + n_folds + 1] for i in range(0, len(grown), n_folds + 1)]
    table = shared_table(out_of_fold(data, keys, label_col, [own[:n_folds] for own in by_point]), "out-of-fold")
    per_fold = table.groupBy("candidate", "fold").agg(F.avg((F.col("prediction") == F.col(label_col)).cast("double")).alias("a"))
    rows = per_fold.collect()  # one row per candidate and fold
    accuracy = [sum(sorted(r["a"] for r in rows if r["candidate"] == i)) / n_folds for i in range(len(points))]
    best = max(range(len(points)), key=lambda i: (accuracy[i], -i))
    return SearchResult(_pipeline(by_point[best][n_folds]), points[best], points, accuracy, table)


def fit_gbt(df: DataFrame, features: Sequence[str], label_col: str, params: Mapping | None = None) -> PipelineModel:
    return _pipeline(boosting.fit(df, features, label_col, params))


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Hard 0/1 predictions appended as an int column; model-internal columns dropped."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").cast("int").alias(out))
