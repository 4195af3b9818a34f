"""Boosted trees against a plain NumPy version, and the ML stages around them."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from faultline.operators import boosting, stages, training

PARAMS = {"learning_rate": 0.5, "max_depth": 3, "n_estimators": 4, "max_bins": 8}


def _rows(n=400, d=5, seed=3, missing=0.15):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.5) | (r.random(n) < 0.05)).astype(int)
    x[r.random(x.shape) < missing] = np.nan
    return x, y


def _frame(spark, x, y):
    rows = [(i, int(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, label int, " + ", ".join(f"f{j} double" for j in range(x.shape[1])))


def _plain(x, y, cuts, p, lam=1.0, least=1.0):
    """One row at a time per split: margins after all trees."""
    m = np.zeros(len(x))
    for _ in range(p["n_estimators"]):
        prob = 1 / (1 + np.exp(-m))
        g = np.rint((prob - y) * boosting.SCALE) / boosting.SCALE
        h = np.rint(prob * (1 - prob) * boosting.SCALE) / boosting.SCALE

        def grow(rows, depth):
            if depth < p["max_depth"]:
                best = None
                for f in range(x.shape[1]):
                    v = x[rows, f]
                    for cut, c in enumerate([*cuts[f], np.inf], 1):
                        for left in (False, True):
                            go = np.where(np.isnan(v), left, v < c)
                            a, b = rows[go], rows[~go]
                            if not len(a) or not len(b) or h[a].sum() < least or h[b].sum() < least:
                                continue
                            if (~np.isnan(x[a, f])).sum() == 0:
                                continue
                            gain = g[a].sum() ** 2 / (h[a].sum() + lam) + g[b].sum() ** 2 / (h[b].sum() + lam) - g[rows].sum() ** 2 / (h[rows].sum() + lam)
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, a, b)
                if best and best[0] > 1e-6:
                    grow(best[1], depth + 1)
                    grow(best[2], depth + 1)
                    return
            m[rows] += -g[rows].sum() / (h[rows].sum() + lam) * p["learning_rate"]

        grow(np.arange(len(x)), 0)
    return m


def test_trees_match_a_plain_version_with_missing_values(spark):
    x, y = _rows()
    df = _frame(spark, x, y)
    model = boosting.fit(df, [f"f{j}" for j in range(5)], "label", PARAMS)
    assert np.allclose(model.margins(x), _plain(x, y, model.cuts, PARAMS), atol=1e-6)
    assert any(left for t in model.trees for _, _, left in t.split.values())  # some default goes left
    got = model.predict(df, probability="p").orderBy("k").toPandas()
    assert ((got["prediction"] == 1) == (model.margins(x) > 0)).all()
    assert np.allclose(got["p"], 1 / (1 + np.exp(-model.margins(x))))


def test_partitions_and_margins_written_between_do_not_matter(spark, monkeypatch):
    x, y = _rows(300)
    feats = [f"f{j}" for j in range(5)]
    one = boosting.fit(_frame(spark, x, y).coalesce(1), feats, "label", PARAMS)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 1)
    other = boosting.fit(_frame(spark, x, y).repartition(7, "k"), feats, "label", PARAMS)
    assert one.trees == other.trees and one.cuts == other.cuts


def test_models_grown_together_are_those_grown_alone(spark):
    x, y = _rows(240, 3)
    df = _frame(spark, x, y).withColumn("fold", (F.col("k") % 3).cast("int"))
    feats = ["f0", "f1", "f2"]
    small = {"learning_rate": 0.3, "max_depth": 1, "n_estimators": 2, "max_bins": 8}
    deep = {**small, "max_depth": 2, "n_estimators": 3}
    together = boosting.fit_many(df, feats, "label", [boosting.Spec(small), boosting.Spec(deep), boosting.Spec(deep, 1)], "fold")
    assert together[0].trees == boosting.fit(df, feats, "label", small).trees
    assert together[1].trees == boosting.fit(df, feats, "label", deep).trees
    assert together[2].trees != together[1].trees and together[2].cuts == together[1].cuts


def test_nothing_to_split_extra_columns_and_bad_parameters(spark):
    df = _frame(spark, np.full((6, 2), np.nan), np.array([0, 0, 0, 0, 1, 1])).withColumn("prediction_of_old", F.lit("x"))
    model = boosting.fit(df, ["f0", "f1"], "label", PARAMS)
    assert all(not t.split and len(t.leaf) == 1 for t in model.trees)
    assert {r.prediction for r in model.predict(df).collect()} == {0}
    assert model.predict(df.limit(0)).count() == 0
    for bad in ({"max_bins": 400}, {"max_depth": 0}, {"reg_lambda": -1.0}):
        with pytest.raises(ValueError):
            boosting.fit(df, ["f0"], "label", {**PARAMS, **bad})


def test_pipeline_is_one_saved_object(spark, tmp_uri):
    x, y = _rows(150, 4)
    df = _frame(spark, x, y)
    feats = [f"f{j}" for j in range(4)]
    pipe = Pipeline(
        stages=[
            stages.NeighborImputer(inputCols=feats, keyCol="k", nNeighbors=3),
            stages.QuantileScaler(inputCols=feats, lower=20.0, upper=80.0),
            stages.BoostedTreesClassifier(inputCols=feats, probabilityCol="p", treeParams=json.dumps(PARAMS)),
        ]
    )
    pipe.write().save(f"{tmp_uri}/unfitted")
    model = Pipeline.load(f"{tmp_uri}/unfitted").fit(df)
    model.write().save(f"{tmp_uri}/fitted")
    back = PipelineModel.load(f"{tmp_uri}/fitted")
    assert [type(s) for s in back.stages] == [stages.NeighborImputerModel, stages.QuantileScalerModel, stages.BoostedTreesModel]
    assert back.stages[0].getOrDefault("nNeighbors") == 3 and back.stages[1].getOrDefault("lower") == 20.0
    want = model.transform(df).orderBy("k").toPandas()
    got = back.transform(df).orderBy("k").toPandas()
    assert (want["prediction"] == got["prediction"]).all() and np.allclose(want["p"], got["p"], atol=1e-9)
    assert not got[feats].isna().any().any()


def test_search_accuracy_is_that_of_the_out_of_fold_table(spark):
    x, y = _rows(200, 3)
    res = training.random_search(_frame(spark, x, y), ["f0", "f1", "f2"], "label", ["k"], {"learning_rate": [0.3, 0.6], "max_depth": [1, 2], "n_estimators": [2, 3]})
    table = res.out_of_fold.toPandas()
    assert len(table) == 200 * 3 and table.groupby("candidate")["k"].nunique().eq(200).all()
    for i, a in enumerate(res.cv_accuracy):
        own = table[table["candidate"] == i]
        assert a == pytest.approx((own["prediction"] == own["label"]).groupby(own["fold"]).mean().mean())
    assert res.best_params == res.candidates[int(np.argmax(res.cv_accuracy))]
