"""Smaller operators: projections, seeded shuffle, fast sampling, approximate
quantiles, p-value modes, rounded scores and registry lookups."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from faultline.functions.stats import ks_pvalue
from faultline.operators import clean, metrics, registry, sampling, scaling
from faultline.spec import ColumnSpec


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "pos", 1.0, 2.0), (2, "neg", 3.0, None)], "k long, class string, a double, b double")
    spec = ColumnSpec(features=("a", "b"))
    xy = clean.split_features_target(df, spec, keys=["k"])
    assert xy.columns == ["k", "a", "b", "label"]
    assert sorted(r["label"] for r in xy.collect()) == [0, 1]
    arr = clean.assemble_array(df, ["a", "b"], keep=["k"]).orderBy("k").collect()
    assert arr[0]["features"] == [1.0, 2.0] and arr[1]["features"][1] is None
    assert clean.filter_class(df, "class", "pos").count() == 1
    out = clean.prepend_prediction(df.withColumn("p", F.lit(1)), "p", ["a", "b"])
    assert out.columns == ["class", "a", "b"] and {r["class"] for r in out.collect()} == {"pos"}


def test_shuffle_rows_is_seeded_and_complete(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    a = [r["k"] for r in sampling.shuffle_rows(df.repartition(3), ["k"], seed=42).collect()]
    b = [r["k"] for r in sampling.shuffle_rows(df.repartition(7), ["k"], seed=42).collect()]
    assert a == b and sorted(a) == list(range(200)) and a != list(range(200))


def test_fast_downsample_keeps_all_positives(spark):
    rows = [(i, "pos" if i % 10 == 0 else "neg") for i in range(5000)]
    df = spark.createDataFrame(rows, "k long, class string")
    out = sampling.downsample(df, "class", ["k"], ratio=0.3, seed=42, exact=False)
    counts = {r["class"]: r["count"] for r in out.groupBy("class").count().collect()}
    assert counts["pos"] == 500 and abs(counts["neg"] - 0.3 * 4500) < 150
    assert sampling.sample_by_fraction(df, "class", {"pos": 1.0, "neg": 0.0}).count() == 500


def test_union_allows_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "k long, x double")
    b = spark.createDataFrame([(2,)], "k long")
    u = sampling.union_frames([a, b], allow_missing=True).orderBy("k").collect()
    assert [tuple(r) for r in u] == [(1, 2.0), (2, None)]


def test_approx_quantiles_close_to_exact(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    exact = {r["prob"]: r["value"] for r in scaling.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    approx = {r["prob"]: r["value"] for r in scaling.approx_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    assert exact == {0.25: 2500.0, 0.5: 5000.0, 0.75: 7500.0}
    assert all(abs(approx[p] - exact[p]) <= 2 for p in exact)
    m = scaling.RobustScaler(method="approx").fit(df, ["x"])
    assert abs(m.center["x"] - 5000.0) <= 2


def test_pvalue_modes_agree_for_large_samples(spark):
    row = spark.range(1).select(
        ks_pvalue(F.lit(0.01), F.lit(50000), F.lit(50000), "asymptotic").alias("a"),
        ks_pvalue(F.lit(0.01), F.lit(50000), F.lit(50000), "stephens").alias("s"),
        ks_pvalue(F.lit(0.5), F.lit(0), F.lit(10), "stephens").alias("empty"),
    ).first()
    assert abs(row["a"] - row["s"]) < 0.01 and row["empty"] is None
    with pytest.raises(ValueError):
        ks_pvalue(F.lit(0.1), F.lit(1), F.lit(1), "exact")


def test_rounded_scores(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0)], "t int, p int")
    r = metrics.rounded_scores(metrics.classification_scores(df, "t", "p")).first()
    assert r["f1_score"] == 0.667 and r["tp"] == 1


def test_registry_latest_by_version(spark, tmp_uri):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0)], "label double, x double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features")]).fit(df)
    reg = registry.ModelRegistry(spark, f"{tmp_uri}/models")
    assert not reg.has_model()
    with pytest.raises(FileNotFoundError):
        reg.best_model_path()
    v1 = reg.promote(model, lambda p: spark.range(1).write.parquet(p), version=100)
    v2 = reg.promote(model, lambda p: spark.range(1).write.parquet(p), version=100)
    assert (v1, v2) == (100, 101)
    assert reg.best_model_path().endswith("version=101/model")
    assert reg.load_latest()[2] == 101
