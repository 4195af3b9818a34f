"""File-stream scoring with the latest registered model."""

import os

from pyspark.sql import functions as F

from faultline.operators import registry, training
from faultline.operators.preprocess import Preprocessor
from faultline.plans import fixtures as fx
from faultline.spec import ColumnSpec
from faultline.streaming.scoring import start_scoring_stream
from tests.conftest import SF_CHECK


def test_stream_scores_new_files(spark, tmp_uri):
    spec = ColumnSpec(features=tuple(fx.VEC_FEATURES), label="class")
    vm = fx.vec_missing(spark, SF_CHECK).withColumn("label", F.when(F.col("class") == "pos", 1).otherwise(0))
    prep = Preprocessor().fit(vm, "vec_id", fx.VEC_FEATURES)
    train = prep.transform(vm.select("vec_id", "label", *fx.VEC_FEATURES))
    model = training.fit_gbt(train, fx.VEC_FEATURES, "label", {"learning_rate": 0.3, "max_depth": 3, "n_estimators": 5})
    reg = registry.ModelRegistry(spark, f"{tmp_uri}/models")
    reg.promote(model, prep.save)

    incoming = f"{tmp_uri}/incoming"
    os.makedirs(incoming)
    rows = vm.select(*[F.coalesce(F.col(c).cast("string"), F.lit("na")).alias(c) for c in fx.VEC_FEATURES]).limit(40)
    rows.toPandas().to_csv(f"{incoming}/part1.csv", index=False)

    q = start_scoring_stream(spark, incoming, spec, f"{tmp_uri}/models", f"{tmp_uri}/out", f"{tmp_uri}/ckpt")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.option("header", True).csv(f"{tmp_uri}/out/batch=*")
    assert out.count() == 40
    assert out.columns[0] == "class"
    assert {r["class"] for r in out.select("class").distinct().collect()} <= {"pos", "neg"}


def test_sensor_model_and_feature_table(spark, tmp_uri):
    from faultline.operators.preprocess import SensorModel
    from faultline.sources import files

    vm = fx.vec_missing(spark, SF_CHECK).withColumn("label", F.when(F.col("class") == "pos", 1).otherwise(0))
    prep = Preprocessor().fit(vm, "vec_id", fx.VEC_FEATURES)
    train = prep.transform(vm.select("vec_id", "label", *fx.VEC_FEATURES), "vec_id")
    files.write_feature_table(train, f"{tmp_uri}/ft", fx.VEC_FEATURES, "label", ["vec_id"])
    table = files.read_feature_table(spark, f"{tmp_uri}/ft")
    assert table.columns == ["vec_id", *fx.VEC_FEATURES, "label"] and table.count() == vm.count()
    model = training.fit_gbt(table, fx.VEC_FEATURES, "label", {"learning_rate": 0.3, "max_depth": 3, "n_estimators": 5})
    pred = SensorModel(prep, model).predict(vm.select("vec_id", *fx.VEC_FEATURES), "vec_id")
    assert pred.count() == vm.count()
    assert {r["prediction"] for r in pred.select("prediction").distinct().collect()} <= {0, 1}
