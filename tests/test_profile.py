"""Drift against stored profiles: the exact test's verdicts, with the baseline left unread where bounds settle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import drift, profile

COLS = ["same", "far", "ties", "holes", "empty"]
SCHEMA = "same double, far double, ties int, holes double, empty double, name string"


def _table(spark, seed, n, shift):
    r = np.random.default_rng(seed)
    rows = [
        (float(r.normal()), float(r.normal() + shift), int(r.integers(0, 4)), float(r.normal()) if r.random() < 0.7 else (None if r.random() < 0.5 else float("nan")), None, f"v{r.integers(0, 3)}")
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _exact_d(a, b):
    grid = np.concatenate([a, b])
    return np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)).max()


@pytest.mark.parametrize("k", [256, profile.SKETCH_K])
def test_bounds_hold_the_statistic(spark, k):
    a, b = _table(spark, 1, 3000, 0.0), _table(spark, 2, 2000, 0.4)
    got = {r["column"]: r for r in profile.statistic_bounds(profile.profile(a, COLS, k), profile.profile(b, COLS, k), k).collect()}
    x, y = a.toPandas(), b.toPandas()
    for c in COLS[:4]:
        d = _exact_d(x[c].dropna().to_numpy(float), y[c].dropna().to_numpy(float))
        assert got[c]["d_low"] <= d <= got[c]["d_high"], c
        if k > 3000:  # exact sketches: only the grid's width is left
            assert got[c]["d_high"] - got[c]["d_low"] <= 2.01 / profile.STEPS
    assert got["holes"]["n_base"] == x["holes"].notna().sum() and got["holes"]["null_base"] == x["holes"].isna().sum()
    assert got["empty"]["d_low"] is None and got["empty"]["n_base"] == 0


def test_same_verdicts_and_only_close_columns_read_again(spark, tmp_uri):
    a, b = _table(spark, 3, 3000, 0.0), _table(spark, 4, 3000, 0.5)
    profile.save_profile(profile.profile(a, COLS), f"{tmp_uri}/profile")
    stored = profile.load_profile(spark, f"{tmp_uri}/profile")

    def unread():
        raise AssertionError("the baseline was read")

    clear = profile.drift_by_profile(stored, b, ["same", "far", "empty"], unread).collect()
    assert {r["column"]: r["drift_status"] for r in clear} == {"same": False, "far": True, "empty": False}
    wide = {r["column"]: r for r in profile.drift_by_profile(stored, b, [*COLS, "name"], lambda: a).collect()}
    exact = {r["column"]: r for r in drift.ks_drift_report(a, b, [*COLS, "name"]).collect()}
    assert {c: r["drift_status"] for c, r in wide.items()} == {c: r["drift_status"] for c, r in exact.items()}
    assert not wide["name"]["settled"] and wide["far"]["settled"]
    kept = profile.drift_by_profile(stored, b, ["holes"], unread, nan_policy="propagate").first()
    assert kept["drift_status"] is False and kept["d_low"] is None


def test_merged_parts_equal_the_whole(spark):
    a = _table(spark, 5, 1000, 0.0)
    parts = [profile.profile(a.filter(F.col("ties") % 2 == i), COLS) for i in (0, 1)]
    whole = {r["column"]: r for r in profile.profile(a, COLS).collect()}
    for r in profile.merge_profiles(parts).collect():
        assert (r["n"], r["nulls"]) == (whole[r["column"]]["n"], whole[r["column"]]["nulls"])
    same = profile.statistic_bounds(profile.merge_profiles(parts), profile.profile(a, COLS))
    assert {r["column"]: r["d_low"] for r in same.collect()} == {c: (None if c == "empty" else 0.0) for c in COLS}


def test_types_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    with pytest.raises(ValueError, match="n"):
        profile.profile(df, ["n"])
    none = spark.createDataFrame([], SCHEMA)
    r = profile.profile(none, COLS).collect()
    assert len(r) == len(COLS) and all(x["n"] == 0 and x["sketch"] is None for x in r)
