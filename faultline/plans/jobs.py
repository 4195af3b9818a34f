"""User-level batch jobs: ETL load, training run and batch scoring.

Each job is a chain of lazy DataFrames materialised only where a table is read
several times (feature-store snapshot, split tables, resampled training
table).  Every path is a URI, so the same code runs on a cluster's shared
storage.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.labels import decode_label, encode_label
from faultline.operators import clean, drift, evaluation, metrics, registry, resample, sampling, training, validation
from faultline.operators.preprocess import Preprocessor, PreprocessorModel
from faultline.operators.stages import sensor_pipeline
from faultline.sources import documents, files, reports
from faultline.session import shared_table
from faultline.spec import ColumnSpec

ROW_ID = "row_id"


# -- J1 ---------------------------------------------------------------------------
def run_etl(
    spark: SparkSession,
    csv_path: str,
    collection_path: str,
    label_col: str = "class",
    ratio: float = 0.3,
    seed: int = 42,
    header_line: int = 14,
    batch_size: int = 5000,
) -> int:
    """Preamble CSV -> all positives + seeded ``ratio`` of negatives ->
    replace the document collection.  Returns the number of rows loaded."""
    raw = files.read_preamble_csv(spark, csv_path, header_line, null_value=None)
    keyed = shared_table(clean.with_row_key(raw, "_fl_key"), "etl")
    sampled = sampling.downsample(keyed, label_col, ["_fl_key"], ratio=ratio, seed=seed).drop("_fl_key")
    return documents.write_documents(sampled, collection_path, batch_size=batch_size, mode="overwrite")


# -- J2 ---------------------------------------------------------------------------
@dataclass
class TrainingResult:
    run_dir: str
    drift_report: DataFrame
    no_drift: bool
    train_scores: DataFrame
    test_scores: DataFrame
    evaluation: DataFrame
    accepted: bool
    version: int | None
    search: training.SearchResult | None = field(default=None, repr=False)


def _scores_for(pred: DataFrame, label: str, timestamp: int) -> DataFrame:
    return metrics.classification_scores(pred, label, "prediction", timestamp=F.lit(timestamp))


def run_training(
    spark: SparkSession,
    source_path: str,
    spec: ColumnSpec,
    work_dir: str,
    registry_root: str,
    grid: dict | None = None,
    n_iter: int = 3,
    n_folds: int = 3,
    test_size: float = 0.2,
    split_seed: int = 1,
    resample_seed: int = 0,
    resample_test: bool = False,
    nan_policy: str = "omit",
    enforce_gates: bool = True,
    timestamp: int | None = None,
) -> TrainingResult:
    now = int(time.time()) if timestamp is None else int(timestamp)  # one stamp for the whole run
    run_dir = f"{work_dir.rstrip('/')}/run={now}"
    label = spec.label
    # ingest: snapshot with a stable row id (before dropping columns), then strict drop
    src = clean.with_row_key(documents.read_documents(spark, source_path), ROW_ID)
    store = files.snapshot(src, f"{run_dir}/feature_store")
    table = clean.drop_strict(store, spec.drop)
    validation.assert_valid(validation.violations({"input": table.drop(ROW_ID)}, spec, check_values=False))
    split = sampling.stratified_split(table, label, [ROW_ID], test_size, split_seed)
    files.write_parquet(split, f"{run_dir}/ingested", partition_by=["split"])
    ingested = spark.read.parquet(f"{run_dir}/ingested")
    train_raw, test_raw = sampling.train_test_frames(ingested)

    # validate: all checks, one failure message
    validation.assert_valid(
        validation.violations({"train": train_raw.drop(ROW_ID), "test": test_raw.drop(ROW_ID)}, spec)
    )
    train = clean.cast_features(train_raw, spec.features)
    test = clean.cast_features(test_raw, spec.features)
    sided = clean.cast_features(ingested, spec.features).withColumn("_fl_test", F.col("split") == "test")
    report = drift.ks_drift_by_side(sided, "_fl_test", [label, *spec.features], nan_policy=nan_policy)
    reports.write_report(report, f"{run_dir}/drift_report")
    report = spark.read.json(f"{run_dir}/drift_report")
    no_drift = bool(drift.drift_verdict(report).first()["no_drift"])  # informational, as in the reference

    # transform: fit on train only, replay on test
    used = [ROW_ID, label, *spec.features]
    prep, train_out = Preprocessor().fit_transform(train.select(*used), ROW_ID, spec.features)
    lab = "label"

    def prepared(df: DataFrame) -> DataFrame:
        return df.select(F.col(ROW_ID).alias(resample.ROW_ID), label, *spec.features)

    # imputed and scaled once each; resampling and the evaluation below read what is written
    files.write_parquet(prepared(train_out), f"{run_dir}/prepared/train")
    files.write_parquet(prepared(prep.transform(test.select(*used), ROW_ID)), f"{run_dir}/prepared/test")
    train_p = spark.read.parquet(f"{run_dir}/prepared/train")
    test_t = test_p = spark.read.parquet(f"{run_dir}/prepared/test")
    train_bal = resample.smote_tomek(train_p, label, spec.features, seed=resample_seed)
    if resample_test:
        test_t = resample.smote_tomek(test_t, label, spec.features, seed=resample_seed)
    train_m = train_bal.withColumn(lab, encode_label(label))
    test_m = test_t.withColumn(lab, encode_label(label))
    files.write_parquet(train_m, f"{run_dir}/transformed/train")
    files.write_parquet(test_m, f"{run_dir}/transformed/test")
    train_m = spark.read.parquet(f"{run_dir}/transformed/train")
    test_m = spark.read.parquet(f"{run_dir}/transformed/test")

    # train + gates
    search = training.random_search(
        train_m, spec.features, lab, [resample.ROW_ID], grid or training.SMALL_GRID, n_iter, n_folds, split_seed
    )
    model = search.model
    both = training.predict(model, train_m).withColumn("split", F.lit("train")).unionByName(
        training.predict(model, test_m).withColumn("split", F.lit("test"))
    )
    files.write_parquet(both.select(resample.ROW_ID, lab, "prediction", "split"), f"{run_dir}/predictions")
    both = spark.read.parquet(f"{run_dir}/predictions")
    train_scores = _scores_for(both.filter("split = 'train'"), lab, now)
    test_scores = _scores_for(both.filter("split = 'test'"), lab, now)
    gates = evaluation.adequacy_gates(both, lab, "prediction")
    if enforce_gates:
        evaluation.assert_gates(gates)

    # evaluate against the current best on the untransformed train + test rows
    reg = registry.ModelRegistry(spark, registry_root)
    eval_rows = sampling.union_frames([train_p, test_p], allow_missing=True).withColumn(lab, encode_label(label))
    trained_pred = training.predict(model, eval_rows).select(ROW_ID, lab, F.col("prediction").alias("trained_pred"))
    if reg.has_model():
        raw_rows = sampling.union_frames([train, test], allow_missing=True).select(ROW_ID, *spec.features)
        best_pred = _predict_raw(spark, reg, spec, raw_rows).select(ROW_ID, F.col("prediction").alias("best_pred"))
        verdict = evaluation.compare_models(trained_pred.join(best_pred, ROW_ID), lab, "trained_pred", "best_pred")
        reports.write_report(verdict, f"{run_dir}/evaluation_report")
        verdict = spark.read.schema(verdict.schema).json(f"{run_dir}/evaluation_report")
        reports.append_scores(
            spark,
            f"{registry_root.rstrip('/')}/_metrics_history",
            verdict.select(
                F.lit(now).alias("timestamp"),
                *[F.col(f"trained_{c}").alias(c) for c in metrics.SCORE_COLUMNS],
            ),
        )
    else:
        verdict = evaluation.compare_models(trained_pred, lab, "trained_pred")
    accepted = bool(verdict.first()["is_model_accepted"])
    version = None
    if accepted:
        row = test_scores.first()
        whole = sensor_pipeline(prep, model, ROW_ID)
        version = reg.promote(whole, scores={"f1_score": row["f1_score"], "roc_auc_score": row["roc_auc_score"]})
    return TrainingResult(run_dir, report, no_drift, train_scores, test_scores, verdict, accepted, version, search)


def _predict_raw(spark: SparkSession, reg: registry.ModelRegistry, spec: ColumnSpec, rows: DataFrame) -> DataFrame:
    """``rows`` (``row_id``, raw features) predicted by the latest model of ``reg``."""
    model, prep_path, _ = reg.load_latest()
    if prep_path:  # a version whose preprocessor was saved apart
        rows = PreprocessorModel.load(spark, prep_path, spec.features).transform(rows, ROW_ID)
    return training.predict(model, rows)


# -- J3 ---------------------------------------------------------------------------
def score_frame(
    raw: DataFrame, spec: ColumnSpec, model, prep: PreprocessorModel | None = None, materialise: bool = False
) -> DataFrame:
    """Clean, validate, transform once, predict; output the decoded class
    followed by the *raw* feature values.  ``model`` preprocesses itself unless ``prep`` is given.

    Rows get a key from their content for the imputation join; ``materialise``
    writes the keyed rows, which are read several times."""
    df = clean.drop_lenient(raw, spec.drop)
    df = clean.missing_to_null(df)
    validation.assert_valid(validation.violations({"input": df}, spec, expect_label=False, check_values=False))
    df = clean.with_row_key(clean.cast_features(df, spec.features), ROW_ID)
    keep = df.select(ROW_ID, *[F.col(c).alias(f"_fl_raw_{c}") for c in spec.features], *spec.features)
    if materialise:
        keep = shared_table(keep)
    scored = training.predict(model, keep if prep is None else prep.transform(keep, ROW_ID))
    return scored.select(
        decode_label(F.col("prediction")).alias(spec.label),
        *[F.col(f"_fl_raw_{c}").alias(c) for c in spec.features],
    )


def run_scoring(spark: SparkSession, input_path: str, spec: ColumnSpec, registry_root: str, out_dir: str) -> DataFrame:
    raw = files.read_sensor_csv(spark, input_path, null_value=None)  # the copy keeps "na"
    files.write_csv(raw, f"{out_dir.rstrip('/')}/sensor_raw")
    model, prep_path, _ = registry.ModelRegistry(spark, registry_root).load_latest()
    prep = PreprocessorModel.load(spark, prep_path, spec.features) if prep_path else None
    out = score_frame(raw, spec, model, prep, materialise=True)
    files.write_csv(out, f"{out_dir.rstrip('/')}/sensor_output")
    return spark.read.option("header", True).csv(f"{out_dir.rstrip('/')}/sensor_output")
