"""Hand-worked cases: KS with ties, p-value law, robust scaler edge cases,
single-class metrics, sampling properties, validation messages."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.functions.stats import kolmogorov_sf
from faultline.operators import clean, drift, metrics, sampling, scaling, validation
from faultline.spec import TRUCK_SPEC, ColumnSpec


def test_kolmogorov_sf_known_value(spark):
    p = spark.range(1).select(kolmogorov_sf(F.lit(1.36)).alias("p")).first()["p"]
    assert abs(p - 0.0494) < 5e-4
    assert spark.range(1).select(kolmogorov_sf(F.lit(0.1)).alias("p")).first()["p"] == 1.0


def _ks_d(a, b):
    a, b = np.sort(a), np.sort(b)
    allv = np.concatenate([a, b])
    cdf1 = np.searchsorted(a, allv, side="right") / len(a)
    cdf2 = np.searchsorted(b, allv, side="right") / len(b)
    return np.max(np.abs(cdf1 - cdf2))


def test_ks_statistic_with_heavy_ties(spark):
    a = [1.0] * 50 + [2.0] * 30 + [3.0] * 20
    b = [1.0] * 20 + [2.0] * 30 + [3.0] * 40 + [4.0] * 10
    base = spark.createDataFrame([(x,) for x in a], "x double")
    cur = spark.createDataFrame([(x,) for x in b], "x double")
    r = drift.ks_drift_report(base, cur, ["x"]).first()
    assert r["d_statistic"] == pytest.approx(_ks_d(np.array(a), np.array(b)))
    assert r["n_base"] == 100 and r["n_current"] == 100


def test_ks_nan_policy(spark):
    base = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    cur = spark.createDataFrame([(1.5,), (2.5,), (float("nan"),)], "x double")
    omit = drift.ks_drift_report(base, cur, ["x"]).first()
    assert omit["null_base"] == 1 and omit["null_current"] == 1 and omit["d_statistic"] is not None
    prop = drift.ks_drift_report(base, cur, ["x"], nan_policy="propagate").first()
    assert prop["d_statistic"] is None and prop["p_value"] is None and prop["drift_status"] is False


def test_ks_string_column(spark):
    base = spark.createDataFrame([("neg",)] * 90 + [("pos",)] * 10, "c string")
    cur = spark.createDataFrame([("neg",)] * 50 + [("pos",)] * 50, "c string")
    r = drift.ks_drift_report(base, cur, ["c"]).first()
    assert r["d_statistic"] == pytest.approx(0.4)
    assert r["drift_status"] is True


def test_robust_scaler_edge_cases(spark):
    rows = [(float(i), 9.0, None, float(i % 7)) for i in range(101)]
    df = spark.createDataFrame(rows, "a double, const double, empty double, b double")
    m = scaling.RobustScaler().fit(df, ["a", "const", "empty", "b"])
    assert m.center["a"] == 50.0 and m.scale["a"] == 50.0
    assert m.center["const"] == 9.0 and m.scale["const"] == 1.0  # zero IQR divides by 1
    assert m.center["empty"] is None
    vals = np.array([i % 7 for i in range(101)], dtype=float)
    q25, q50, q75 = np.percentile(vals, [25, 50, 75])
    assert m.center["b"] == pytest.approx(q50) and m.scale["b"] == pytest.approx(q75 - q25)
    out = m.transform(df).collect()
    assert all(r["const"] == 0.0 and r["empty"] is None for r in out)
    assert sorted(r["a"] for r in out)[9] == pytest.approx((9 - 50) / 50)


def test_metrics_single_class_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1)], "t int, p int")
    r = metrics.classification_scores(df, "t", "p").first()
    assert r["f1_score"] == 0.0 and r["precision_score"] == 0.0 and r["recall_score"] == 0.0
    assert r["roc_auc_score"] is None


def test_metrics_hand_worked(spark):
    # tn 299, fp 49, fn 42, tp 9
    rows = [(0, 0)] * 299 + [(0, 1)] * 49 + [(1, 0)] * 42 + [(1, 1)] * 9
    r = metrics.classification_scores(spark.createDataFrame(rows, "t int, p int"), "t", "p").first()
    assert r["f1_score"] == pytest.approx(18 / (18 + 49 + 42))
    po = (299 + 9) / 399
    pe = ((9 + 42) * (9 + 49) + (299 + 49) * (299 + 42)) / 399**2
    assert r["cohen_kappa_score"] == pytest.approx((po - pe) / (1 - pe))
    assert r["roc_auc_score"] == pytest.approx((9 / 51 + 299 / 348) / 2)


def test_split_is_disjoint_complete_and_partition_independent(spark):
    rows = [(i, "pos" if i % 13 == 0 else "neg") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, class string")
    a = sampling.stratified_split(df.repartition(3), "class", ["k"]).collect()
    b = sampling.stratified_split(df.repartition(11), "class", ["k"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len(a) == 3000 and len({r["k"] for r in a}) == 3000
    n_test = sum(r["split"] == "test" for r in a)
    assert n_test == math.ceil(0.2 * 3000)
    pos_test = sum(r["split"] == "test" and r["class"] == "pos" for r in a)
    assert abs(pos_test - 0.2 * sum(r["class"] == "pos" for r in a)) <= 1


def test_downsample_exact_count(spark):
    rows = [(i, "pos" if i % 20 == 0 else "neg") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, class string")
    out = sampling.downsample(df, "class", ["k"], ratio=0.3, seed=42)
    counts = {r["class"]: r["count"] for r in out.groupBy("class").count().collect()}
    assert counts["pos"] == 100 and counts["neg"] == round(0.3 * 1900)


def test_validation_collects_all_messages(spark):
    spec = ColumnSpec(features=("a", "b", "c"))
    df = spark.createDataFrame([("pos", "1", "x")], "class string, a string, b string")
    v = validation.violations({"train": df, "test": df}, spec)
    checks = sorted((r["frame"], r["check"]) for r in v.collect())
    assert ("train", "column_count") in checks and ("test", "missing_numeric_column") in checks
    assert ("train", "non_numeric_values") in checks
    with pytest.raises(validation.ValidationError):
        validation.assert_valid(v)


def test_clean_and_label_codes(spark):
    df = spark.createDataFrame([("neg", "na", "1"), ("pos", "2.5", "na")], "class string, a string, b string")
    out = clean.with_label_code(clean.clean_sensor_table(df, ColumnSpec(features=("a", "b"))), "class")
    assert [tuple(r) for r in out.orderBy("class").collect()] == [("neg", None, 1.0, 0), ("pos", 2.5, None, 1)]
    bad = spark.createDataFrame([("maybe",)], "class string")
    with pytest.raises(Exception):
        clean.with_label_code(bad, "class").collect()


def test_strict_drop_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        clean.drop_strict(df, ["b"])
    assert clean.drop_lenient(df, ["b"]).columns == ["a"]


def test_truck_spec_shape():
    assert len(TRUCK_SPEC.features) == 163 and len(TRUCK_SPEC.columns) == 164 and len(TRUCK_SPEC.drop) == 7


def test_ks_single_row_sides_do_not_fail(spark):
    base = spark.createDataFrame([(1.0,)], "x double")
    cur = spark.createDataFrame([(2.0,)], "x double")
    r = drift.ks_drift_report(base, cur, ["x"]).first()
    assert r["d_statistic"] == 1.0 and 0.0 <= r["p_value"] <= 1.0


def test_ks_laws_against_published_and_enumerated_values(spark):
    """Tabulated 5 % points of the one-sample statistic, and orderings counted one by one."""
    import itertools

    from faultline.functions import kslaw

    for n, d in ((5, 0.56328), (10, 0.40925), (20, 0.29408), (100, 0.13403)):
        assert abs(kslaw.one_sample_sf(d, n) - 0.05) < 1e-4
    for z in (0.6, 0.9, 1.36, 2.2):  # the expansion takes over where the matrix ends
        d = z / 2000**0.5
        assert abs(kslaw._durbin_cdf(d, 2000) - kslaw._pelz_good_cdf(d, 2000)) < 2e-6
    for n1, n2, d in ((4, 5, 0.6), (6, 4, 0.5), (7, 3, 2 / 3)):
        hits = []
        for c in itertools.combinations(range(n1 + n2), n1):
            i = j = worst = 0
            for k in range(n1 + n2):
                i, j = (i + 1, j) if k in c else (i, j + 1)
                worst = max(worst, abs(i * n2 - j * n1))
            hits.append(worst >= round(d * n1 * n2))
        assert abs(kslaw.two_sample_exact(d, n1, n2) - sum(hits) / len(hits)) < 1e-12
    base = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    cur = spark.createDataFrame([(float(i) + 1.5,) for i in range(5)], "x double")
    r = drift.ks_drift_report(base, cur, ["x"]).first()
    assert abs(r["p_value"] - kslaw.two_sample_exact(r["d_statistic"], 4, 5)) < 1e-12
    # whole numbers above 2**53 stay apart
    big = [spark.createDataFrame([(2**53 + k,)] * 50, "x long") for k in (0, 1)]
    assert drift.ks_drift_report(*big, ["x"]).first()["d_statistic"] == 1.0
