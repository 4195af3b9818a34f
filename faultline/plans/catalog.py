"""Registered queries: one per operator family, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``oracle.py``.  Floating results are rounded
to 6 decimals here (presentation only; the operators keep full precision).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import clean, drift, evaluation, impute, metrics, profile, resample, sampling, scaling, training, validation
from faultline.session import cut_lineage, shared_table
from faultline.plans import fixtures as fx
from faultline.plans import roundtrips
from faultline.spec import ColumnSpec

DIGITS = 6
SPLIT_SEED = 1
SAMPLE_SEED = 42
SQL_PVALUE = fx.SQL_PVALUE


def _round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    from pyspark.sql import types as T

    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def sensor_clean_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sensor_table(fx.sensor_raw(spark, sf_dir), fx.SENSOR_SPEC)


def sensor_split_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split is read by several branches; it is written once (checkpoint
    in the shared folder) as the training job writes its split tables."""
    return shared_table(
        sampling.stratified_split(sensor_clean_frame(spark, sf_dir), "class", fx.SENSOR_KEYS, 0.2, SPLIT_SEED)
    )


# -- V5/V6 drift ---------------------------------------------------------------
def q_drift_lineitem(spark, sf_dir):
    return _round_doubles(drift.ks_drift_by_side(fx.lineitem_sides(spark, sf_dir), "late", fx.SENSOR_MEASURES, pvalue_method=SQL_PVALUE))


def q_drift_events(spark, sf_dir):
    return _round_doubles(drift.ks_drift_by_side(fx.events_sides(spark, sf_dir), "late", ["value", "event_type"], pvalue_method=SQL_PVALUE))


def q_drift_shifted(spark, sf_dir):
    """Hash-halved lineitem with 0.01 added to ``l_discount`` on one half:
    exactly that column must drift."""
    li = fx.table(spark, sf_dir, "lineitem")
    half = F.substring(F.md5(F.concat_ws(":", F.lit("half"), *[F.col(k).cast("string") for k in fx.SENSOR_KEYS])), 1, 1)
    sided = li.withColumn("shifted", half.isin(*"01234567")).withColumn(
        "l_discount", F.col("l_discount") + F.when(F.col("shifted"), F.lit(0.01)).otherwise(F.lit(0.0))
    )
    return _round_doubles(drift.ks_drift_by_side(sided, "shifted", fx.SENSOR_MEASURES, pvalue_method=SQL_PVALUE))


def q_drift_sensor_propagate(spark, sf_dir):
    """Reference semantics: train vs test over every column, label included;
    columns with any missing value get no statistic and cannot drift."""
    split = sensor_split_frame(spark, sf_dir).withColumn("is_test", F.col("split") == "test")
    return _round_doubles(drift.ks_drift_by_side(split, "is_test", ["class", *fx.SENSOR_MEASURES], nan_policy="propagate", pvalue_method=SQL_PVALUE))


def q_drift_verdict(spark, sf_dir):
    """V6: one row, ``no_drift`` only when no column drifted."""
    return drift.drift_verdict(drift.ks_drift_by_side(fx.lineitem_sides(spark, sf_dir), "late", fx.SENSOR_MEASURES, pvalue_method=SQL_PVALUE))


def q_drift_profile(spark, sf_dir):
    """V5/V6 against a stored profile: the early rows' sketches are written and read back;
    the early rows themselves are read again only for columns that the sketches leave open."""
    sides = fx.lineitem_sides(spark, sf_dir)
    early, late = sides.filter(~F.col("late")), sides.filter("late")
    cols = [c for c in fx.SENSOR_MEASURES if profile.sketchable(sides.schema[c].dataType)]
    stored = shared_table(profile.profile(early, cols), "stored-profile")
    report = profile.drift_by_profile(stored, late, fx.SENSOR_MEASURES, lambda: early, pvalue_method=SQL_PVALUE)
    return report.drop("d_low", "d_high", "settled")


# -- P2-P6 cleaning ------------------------------------------------------------
def q_sensor_clean(spark, sf_dir):
    df = sensor_clean_frame(spark, sf_dir)
    return clean.with_label_code(df, "class")


def q_decoded_predictions(spark, sf_dir):
    """P7/P10: a 0/1 prediction decoded to ``neg``/``pos`` as the first column,
    followed by the feature columns."""
    lab = fx.table(spark, sf_dir, "labels").withColumn("prediction", F.lit(1) - F.col("quality"))
    return clean.prepend_prediction(lab, "prediction", ["doc_id", "quality", "toxic"])


# -- V1-V4 schema checks -------------------------------------------------------
def q_schema_violations(spark, sf_dir):
    raw = fx.sensor_raw(spark, sf_dir)
    split = shared_table(sampling.stratified_split(raw, "class", fx.SENSOR_KEYS, 0.2, SPLIT_SEED))
    train, test = sampling.train_test_frames(split)
    spec = ColumnSpec(features=(*fx.SENSOR_MEASURES, "sensor_x"), label="class")
    return validation.violations({"train": train, "test": test}, spec)


# -- N1/U1 downsampling, N3 split ----------------------------------------------
def q_downsample_sensor(spark, sf_dir):
    raw = fx.sensor_raw(spark, sf_dir)
    return sampling.downsample(raw, "class", fx.SENSOR_KEYS, ratio=0.3, seed=SAMPLE_SEED)


def q_split_sensor(spark, sf_dir):
    raw = fx.sensor_raw(spark, sf_dir)
    return sampling.stratified_split(raw, "class", fx.SENSOR_KEYS, 0.2, SPLIT_SEED).select(
        *fx.SENSOR_KEYS, "class", "split"
    )


# -- A1-A6 metrics -------------------------------------------------------------
def _pred_pair(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels")
    return lab.select("doc_id", F.col("toxic").alias("y_true"), (F.lit(1) - F.col("quality")).alias("y_pred"))


def q_classification_metrics(spark, sf_dir):
    return _round_doubles(metrics.classification_scores(_pred_pair(spark, sf_dir), "y_true", "y_pred"))


# -- F2 robust scaling ---------------------------------------------------------
def _scaler_fit(spark, sf_dir):
    train, _ = sampling.train_test_frames(sensor_split_frame(spark, sf_dir))
    return scaling.robust_scaler_params(train, fx.SENSOR_MEASURES)


def q_robust_scaler_fit(spark, sf_dir):
    return _round_doubles(_scaler_fit(spark, sf_dir))


def q_robust_scale(spark, sf_dir):
    """Fit on the training rows, then scale every row.  The written split
    holds all rows, so it is read for both instead of recomputing the view."""
    split = sensor_split_frame(spark, sf_dir)
    train, _ = sampling.train_test_frames(split)
    params = scaling.robust_scaler_params(train, fx.SENSOR_MEASURES)
    model = scaling.RobustScalerModel.from_params(params, order=fx.SENSOR_MEASURES)
    return _round_doubles(model.transform(split.select(*fx.SENSOR_KEYS, *fx.SENSOR_MEASURES)))


# -- F1 nearest-neighbour imputation -------------------------------------------
def q_knn_impute(spark, sf_dir):
    vm = fx.vec_missing(spark, sf_dir)
    split = sampling.stratified_split(vm, "class", ["vec_id"], 0.2, SPLIT_SEED)
    train, _ = sampling.train_test_frames(split)
    model = impute.KNNImputer(n_neighbors=5).fit(train, "vec_id", fx.VEC_FEATURES)
    return _round_doubles(model.transform(vm))


# -- F4/F5/F6 rebalancing ------------------------------------------------------
def _vec_rows(spark, sf_dir):
    return resample.with_row_id(fx.vec_wide(spark, sf_dir), "vec_id").drop("vec_id")


def q_smote(spark, sf_dir):
    return _round_doubles(resample.smote_balance(_vec_rows(spark, sf_dir), "class", fx.VEC_FEATURES, k=5, seed=0))


def q_tomek_links(spark, sf_dir):
    return resample.tomek_links(_vec_rows(spark, sf_dir), "class", fx.VEC_FEATURES)


def q_smote_tomek(spark, sf_dir):
    balanced = cut_lineage(resample.smote_balance(_vec_rows(spark, sf_dir), "class", fx.VEC_FEATURES, k=5, seed=0))
    return _round_doubles(resample.remove_tomek_links(balanced, "class", fx.VEC_FEATURES))


# -- M5/M6 gates, M7 champion/challenger on given predictions ----------------------
def q_adequacy_gates(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels").select(
        "doc_id", F.col("toxic").alias("class"), (F.lit(1) - F.col("quality")).alias("y_pred")
    )
    split = sampling.stratified_split(lab, "class", ["doc_id"], 0.2, SPLIT_SEED)
    return _round_doubles(evaluation.adequacy_gates(split, "class", "y_pred"))


def q_champion_challenger(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    scored = lab.join(docs, "doc_id", "left").select(
        F.col("toxic").alias("y_true"),
        (F.lit(1) - F.col("quality")).alias("trained_pred"),
        F.when((F.col("quality") == 0) & (F.col("n_chars") < 1500), 1).otherwise(0).alias("best_pred"),
    )
    return _round_doubles(evaluation.compare_models(scored, "y_true", "trained_pred", "best_pred"))


# -- M1-M4 boosted trees, M2 random search
def _vec_labelled(spark, sf_dir):
    vw = fx.vec_wide(spark, sf_dir).withColumn("label", F.when(F.col("class") == "pos", 1).otherwise(0))
    return cut_lineage(sampling.stratified_split(vw, "class", ["vec_id"], 0.2, SPLIT_SEED))


def q_gbt_predict(spark, sf_dir):
    split = _vec_labelled(spark, sf_dir)
    train, test = sampling.train_test_frames(split)
    model = training.fit_gbt(train, fx.VEC_FEATURES, "label", fx.TREES)
    return training.predict(model, test.select("vec_id", "class", "label", *fx.VEC_FEATURES)).select(
        "vec_id", "class", "label", "prediction"
    )


def q_random_search(spark, sf_dir):
    split = _vec_labelled(spark, sf_dir)
    train, _ = sampling.train_test_frames(split)
    res = training.random_search(train, fx.VEC_FEATURES, "label", ["vec_id"], training.SMALL_GRID, n_iter=3, n_folds=3)
    rows = [
        (p["learning_rate"], p["max_depth"], p["n_estimators"], float(m), p == res.best_params)
        for p, m in zip(res.candidates, res.cv_accuracy)
    ]
    return spark.createDataFrame(rows, "learning_rate double, max_depth int, n_estimators int, cv_accuracy double, chosen boolean")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **roundtrips.QUERIES,
    "drift_lineitem": q_drift_lineitem,
    "drift_events": q_drift_events,
    "drift_shifted": q_drift_shifted,
    "drift_sensor_propagate": q_drift_sensor_propagate,
    "drift_verdict": q_drift_verdict,
    "drift_profile": q_drift_profile,
    "sensor_clean": q_sensor_clean,
    "decoded_predictions": q_decoded_predictions,
    "schema_violations": q_schema_violations,
    "downsample_sensor": q_downsample_sensor,
    "split_sensor": q_split_sensor,
    "classification_metrics": q_classification_metrics,
    "robust_scaler_fit": q_robust_scaler_fit,
    "robust_scale": q_robust_scale,
    "knn_impute": q_knn_impute,
    "smote": q_smote,
    "tomek_links": q_tomek_links,
    "smote_tomek": q_smote_tomek,
    "adequacy_gates": q_adequacy_gates,
    "champion_challenger": q_champion_challenger,
    "gbt_predict": q_gbt_predict,
    "random_search": q_random_search,
}
