"""Registered queries that write a table, read it back and return what came back.

They put sources, sinks, fitted state, the registry and the scoring job under the
SQL oracle: each runs the operator on one of the driver's tables, writing to a
folder of its own under the shared checkpoint folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import boosting, clean, drift, metrics, ranking, registry, resample, sampling, stages, training, validation
from faultline.operators.preprocess import Preprocessor, PreprocessorModel
from faultline.plans import fixtures as fx
from faultline.plans import jobs
from faultline.session import checkpoint_dir, shared_table
from faultline.sources import documents, files, reports
from faultline.spec import ColumnSpec

PREAMBLE_LINES = 14
N_FILES = 4
STAMP = 1_700_000_000
FEW = fx.VEC_FEATURES[:4]  # only for smote_tomek_overlap: in four dimensions the classes overlap


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def customer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as a raw sensor file: all text, ``na`` where the balance is negative."""
    c = fx.table(spark, sf_dir, "customer")
    bal = F.when(F.col("c_acctbal") < 0, "na").otherwise(F.floor("c_acctbal").cast("string"))
    return c.select(
        F.when(F.col("c_nationkey") < 3, "pos").otherwise("neg").alias("class"),
        F.col("c_custkey").cast("string").alias("aa_000"),
        bal.alias("ab_000"),
        F.col("c_nationkey").cast("string").alias("br_000"),
    )


def write_preamble_files(df: DataFrame, path: str) -> str:
    """``N_FILES`` CSV files of ``df``, each with a preamble, blank lines and the header."""
    names = df.columns
    body = df.select(
        F.pmod(F.xxhash64(*names), F.lit(N_FILES)).alias("part"), F.lit(99).alias("nth"), F.concat_ws(",", *names).alias("value")
    )
    top = [(p, i, f"licence text, line {i}") for p in range(N_FILES) for i in range(PREAMBLE_LINES)]
    top += [(p, 3, "") for p in range(N_FILES)] + [(p, PREAMBLE_LINES, ",".join(names)) for p in range(N_FILES)]
    lines = body.unionByName(df.sparkSession.createDataFrame(top, "part long, nth int, value string"))
    lines.repartition("part").sortWithinPartitions("part", "nth").select("part", "value").write.partitionBy("part").text(path)
    return f"{path}/*"


# -- sources and sinks -----------------------------------------------------------------
def q_preamble_csv(spark, sf_dir):
    path = write_preamble_files(customer_raw(spark, sf_dir), scratch(spark, "preamble"))
    return files.read_preamble_csv(spark, path, PREAMBLE_LINES)


def q_headed_csv(spark, sf_dir):
    path = scratch(spark, "csv")
    files.write_csv(customer_raw(spark, sf_dir), path)
    return files.read_sensor_csv(spark, path)


def q_documents_replaced(spark, sf_dir):
    """The second load replaces the first; ``n_written`` is the count the sink returns."""
    path = scratch(spark, "documents")
    raw = customer_raw(spark, sf_dir)
    documents.write_documents(raw.withColumn("old", F.lit("1")), path)
    n = documents.write_documents(raw.withColumn("_id", F.lit("x")), path, partition_by=["class"])
    return documents.read_documents(spark, path).withColumn("n_written", F.lit(n).cast("long"))


def q_feature_store(spark, sf_dir):
    return files.snapshot(clean.missing_to_null(customer_raw(spark, sf_dir)), scratch(spark, "store"))


def q_feature_matrix(spark, sf_dir):
    """Feature table written and read, then assembled: position-weighted sum of the array."""
    path = scratch(spark, "matrix")
    vec = clean.split_features_target(fx.vec_wide(spark, sf_dir), fx.VEC_SPEC, keys=["vec_id"])
    files.write_feature_table(vec, path, fx.VEC_FEATURES, "label", ["vec_id"])
    back = files.read_feature_table(spark, path)
    dense = clean.assemble_array(back, fx.VEC_FEATURES, keep=["vec_id", "label"])
    weighted = F.aggregate(
        F.zip_with("features", F.sequence(F.lit(1), F.lit(fx.VEC_DIMS)), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x
    )
    return dense.select("vec_id", "label", F.size("features").alias("width"), F.round(weighted, 6).alias("weighted"))


def q_drift_report_file(spark, sf_dir):
    path = scratch(spark, "report")
    report = drift.ks_drift_by_side(fx.lineitem_sides(spark, sf_dir), "late", fx.SENSOR_MEASURES, pvalue_method=fx.SQL_PVALUE)
    rounded = report.withColumns({c: F.round(c, 6) for c in ("d_statistic", "p_value")})
    reports.write_report(rounded, path)
    return spark.read.schema(rounded.schema).json(path)


def q_metrics_history(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels").select(F.col("toxic").alias("t"), (F.lit(1) - F.col("quality")).alias("p"))
    path = scratch(spark, "history")
    for stamp, rows in ((STAMP, lab), (STAMP + 1, lab.withColumn("p", F.col("t")))):
        reports.append_scores(spark, path, metrics.classification_scores(rows, "t", "p", timestamp=F.lit(stamp)))
    return reports.read_history(spark, path)


# -- projections, unions, order -----------------------------------------------------------
def q_strict_drop(spark, sf_dir):
    return clean.drop_strict(customer_raw(spark, sf_dir), ["br_000"])


def q_lenient_drop(spark, sf_dir):
    raw = customer_raw(spark, sf_dir).withColumn("_id", F.lit("x"))
    return clean.missing_to_null(clean.drop_lenient(raw, ["br_000", "not_there"]))


def q_features_target(spark, sf_dir):
    spec = ColumnSpec(features=("aa_000", "ab_000"), label="class")
    cleaned = clean.cast_features(clean.missing_to_null(customer_raw(spark, sf_dir)), spec.features)
    return clean.split_features_target(cleaned, spec)


def q_class_rows(spark, sf_dir):
    return clean.filter_class(customer_raw(spark, sf_dir), "class", "pos")


def q_union_missing(spark, sf_dir):
    raw = customer_raw(spark, sf_dir)
    pos, neg = (clean.filter_class(raw, "class", c) for c in ("pos", "neg"))
    return sampling.union_frames([pos, neg.drop("ab_000")], allow_missing=True)


def q_shuffled_rows(spark, sf_dir):
    """Seeded shuffle: every customer with its place in the shuffled order."""
    shuffled = sampling.shuffle_rows(fx.table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], seed=42)
    return ranking.number_rows(shuffled, "place")


def q_scoring_violations(spark, sf_dir):
    spec = ColumnSpec(features=("aa_000", "ab_000", "zz_000"), label="class")
    return validation.violations({"input": customer_raw(spark, sf_dir)}, spec, expect_label=False)


# -- fitted state, folds, registry, jobs ------------------------------------------------------
def q_preprocess_state(spark, sf_dir):
    """Imputer and scaler fitted on the training rows, saved, loaded, applied to all rows."""
    rows = fx.vec_missing(spark, sf_dir)
    train, _ = sampling.train_test_frames(sampling.stratified_split(rows, "class", ["vec_id"], 0.2, 1))
    path = scratch(spark, "state")
    Preprocessor().fit(train, "vec_id", fx.VEC_FEATURES).save(path)
    out = PreprocessorModel.load(spark, path, fx.VEC_FEATURES).transform(rows, "vec_id")
    return out.select("vec_id", "class", *[F.round(c, 6).alias(c) for c in fx.VEC_FEATURES])


def q_smote_tomek_overlap(spark, sf_dir):
    """SMOTE + Tomek on four dimensions, where the classes overlap: links survive and go."""
    rows = resample.with_row_id(fx.vec_wide(spark, sf_dir).select("vec_id", "class", *FEW), "vec_id").drop("vec_id")
    out = resample.smote_tomek(rows, "class", FEW, k=5, seed=0)
    return out.select("row_id", "class", *[F.round(c, 6).alias(c) for c in FEW])


def q_search_folds(spark, sf_dir):
    """Rows of each class in each fold of the random search."""
    vec = fx.vec_wide(spark, sf_dir).withColumn("label", F.when(F.col("class") == "pos", 1.0).otherwise(0.0))
    folds = training.stratified_folds(vec.select("vec_id", "label"), "label", ["vec_id"], n_folds=3)
    return folds.groupBy("label", F.col(training.FOLD_COL).alias("fold")).agg(F.count("*").alias("n"))


def _label() -> Column:
    return F.when(F.col("class") == "pos", 1).otherwise(0)


def q_gbt_scored_rows(spark, sf_dir):
    """Trees grown on rows with missing values, which go to each split's default side."""
    rows = fx.vec_missing(spark, sf_dir).withColumn("label", _label())
    trees = boosting.fit(rows, fx.VEC_FEATURES, "label", fx.TREES)
    scored = trees.predict(rows, probability="probability")
    return scored.select("vec_id", "class", "label", "prediction", F.round("probability", 6).alias("probability"))


def q_gbt_nodes(spark, sf_dir):
    """The trees themselves: one row per node; leaves have no feature ('') and cut 0, splits weight 0."""
    rows = fx.vec_missing(spark, sf_dir).withColumn("label", _label())
    nodes = boosting.fit(rows, fx.VEC_FEATURES, "label", fx.TREES).frame(spark)
    none = {"feature": "", "cut_no": 0, "default_left": False, "weight": 0.0}
    return nodes.drop("cut").fillna(none).withColumn("weight", F.round("weight", 6))


def _fitted_pipeline(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineModel]:
    """Imputer, scaler and trees fitted by one ``Pipeline``.  The rows are read several times, so they are written once."""
    rows = shared_table(fx.vec_missing(spark, sf_dir).withColumn("label", _label()), "raw-rows")
    imputer = stages.NeighborImputer(inputCols=fx.VEC_FEATURES, keyCol="vec_id")
    scaler = stages.QuantileScaler(inputCols=fx.VEC_FEATURES)
    trees = stages.BoostedTreesClassifier(inputCols=fx.VEC_FEATURES, treeParams=json.dumps(fx.TREES))
    return rows, Pipeline(stages=[imputer, scaler, trees]).fit(rows)


def q_sensor_model(spark, sf_dir):
    """The pipeline saved and loaded as one object; it preprocesses and predicts raw rows."""
    rows, model = _fitted_pipeline(spark, sf_dir)
    path = scratch(spark, "pipeline")
    model.write().save(path)
    scored = PipelineModel.load(path).transform(rows.drop("label"))
    return scored.select("vec_id", "class", "prediction", *[F.round(c, 6).alias(c) for c in fx.VEC_FEATURES[:2]])


def q_search_accuracy(spark, sf_dir):
    """Random search: accuracy of each candidate over the out-of-fold predictions, and the choice."""
    rows = fx.vec_missing(spark, sf_dir).withColumn("label", _label())
    res = training.random_search(rows, fx.VEC_FEATURES, "label", ["vec_id"], fx.SEARCH_GRID, n_iter=2, n_folds=3)
    found = [
        (p["learning_rate"], p["max_depth"], p["n_estimators"], round(a, 6), p == res.best_params)
        for p, a in zip(res.candidates, res.cv_accuracy)
    ]
    schema = "learning_rate double, max_depth int, n_estimators int, cv_accuracy double, chosen boolean"
    return spark.createDataFrame(found, schema)


def q_registry_entries(spark, sf_dir):
    """Two promoted versions: the latest one, with its scores, whose model folder exists."""
    lab = fx.table(spark, sf_dir, "labels")
    model = Pipeline(stages=[VectorAssembler(inputCols=["quality"], outputCol="v")]).fit(lab)
    reg = registry.ModelRegistry(spark, scratch(spark, "registry"))
    before = reg.has_model()
    for version, pred in ((10, F.col("toxic")), (20, F.lit(1) - F.col("quality"))):
        row = metrics.classification_scores(lab.select("toxic", pred.alias("p")), "toxic", "p").first()
        reg.promote(model, lambda path: None, {"f1_score": row["f1_score"], "roc_auc_score": row["roc_auc_score"]}, version)
    newest = reg.newest_run().first()["version"]
    return reg.entries().join(reg.latest().select("version"), "version").select(
        "version",
        F.round("f1_score", 6).alias("f1_score"),
        F.round("roc_auc_score", 6).alias("roc_auc_score"),
        F.lit(before).alias("had_model"),
        F.lit(reg.has_model()).alias("has_model"),
        F.lit(newest).alias("newest_run"),
    )


def q_batch_scoring(spark, sf_dir):
    """The scoring job over CSV files, columns in another order and one too many: predicted class
    and the raw values as they came."""
    rows, model = _fitted_pipeline(spark, sf_dir)
    model.stages[0].set(model.stages[0].keyCol, jobs.ROW_ID)  # the job's row key
    reg = registry.ModelRegistry(spark, scratch(spark, "models"))
    reg.promote(model)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("na")).alias(c) for c in reversed(fx.VEC_FEATURES)]
    incoming = scratch(spark, "incoming")
    files.write_csv(rows.select(F.lit("x").alias("extra"), *text), incoming)
    spec = ColumnSpec(features=tuple(fx.VEC_FEATURES), label="class", drop=("extra",), keys=("vec_id",))
    out = jobs.run_scoring(spark, incoming, spec, reg.root, scratch(spark, "scored"))
    return out.select("class", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in fx.VEC_FEATURES])


def q_etl_job(spark, sf_dir):
    """Preamble files through the ETL job into the document collection."""
    path = write_preamble_files(customer_raw(spark, sf_dir), scratch(spark, "raw"))
    out = scratch(spark, "collection")
    n = jobs.run_etl(spark, path, out)
    return documents.read_documents(spark, out).withColumn("n_loaded", F.lit(n).cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "preamble_csv": q_preamble_csv,
    "headed_csv": q_headed_csv,
    "documents_replaced": q_documents_replaced,
    "feature_store": q_feature_store,
    "feature_matrix": q_feature_matrix,
    "drift_report_file": q_drift_report_file,
    "metrics_history": q_metrics_history,
    "strict_drop": q_strict_drop,
    "lenient_drop": q_lenient_drop,
    "features_target": q_features_target,
    "class_rows": q_class_rows,
    "union_missing": q_union_missing,
    "shuffled_rows": q_shuffled_rows,
    "scoring_violations": q_scoring_violations,
    "preprocess_state": q_preprocess_state,
    "smote_tomek_overlap": q_smote_tomek_overlap,
    "search_folds": q_search_folds,
    "gbt_scored_rows": q_gbt_scored_rows,
    "gbt_nodes": q_gbt_nodes,
    "sensor_model": q_sensor_model,
    "search_accuracy": q_search_accuracy,
    "registry_entries": q_registry_entries,
    "batch_scoring": q_batch_scoring,
    "etl_job": q_etl_job,
}
