"""Exact quantiles by refinement, compared with NumPy."""

import numpy as np
import pytest

from faultline.operators import quantiles
from faultline.operators.preprocess import Preprocessor

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _columns(n=3000):
    rng = np.random.default_rng(5)
    near = 1.0 + rng.integers(0, 50, n) * 2.0**-52  # differ in the last bits only
    hot = np.where(rng.random(n) < 0.4, 7.25, rng.normal(0, 1e-3, n))
    wide = rng.normal(0, 1, n) * 10.0 ** rng.integers(-300, 300, n)
    signs = rng.choice([-0.0, 0.0, -5e-324, 5e-324, -1.5, 2.0], n)
    holes = np.where(rng.random(n) < 0.3, np.nan, rng.integers(-4, 5, n).astype(float))
    return {"near": near, "hot": hot, "wide": wide, "signs": signs, "holes": holes, "none": np.full(n, np.nan)}


def _frame(spark, data):
    rows = list(zip(*[[None if i % 2 and np.isnan(v) else float(v) for i, v in enumerate(c)] for c in data.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(3)


@pytest.mark.parametrize("finish_rows", [1, quantiles.FINISH_ROWS])
def test_equal_to_numpy(spark, finish_rows):
    data = _columns()
    got = quantiles.exact_quantiles(_frame(spark, data), list(data), PROBS, finish_rows).collect()
    by = {(r["column"], r["prob"]): r["value"] for r in got}
    assert not [k for k in by if k[0] == "none"]
    for name, x in data.items():
        x = np.sort(x[~np.isnan(x)])
        for p in PROBS if len(x) else ():
            h = (len(x) - 1) * p
            lo, hi = x[int(np.floor(h))], x[int(np.ceil(h))]
            assert by[name, p] == lo + (h - np.floor(h)) * (hi - lo), (name, p)


def test_keys_keep_the_order_of_doubles():
    x = np.array([-np.inf, -1e300, -1.0, -5e-324, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2), 1e300, np.inf])
    keys = quantiles.order_keys(x)
    assert (np.diff(keys) > 0).all()
    assert [quantiles.key_value(int(k)) for k in keys] == list(x)
    assert quantiles.order_keys(np.array([-0.0])) == quantiles.order_keys(np.array([0.0]))


def test_tasks_send_counts_not_rows(spark):
    """200,000 rows over few values leave a task as few counts, whatever their number."""
    values = spark.range(0, 200_000, 1, 2).selectExpr("cast(id % 40 as double) AS c0")
    o = quantiles._Open(0, 64, np.zeros(1, np.int64), np.array([0], np.int32), np.array([0], np.int64))
    assert values.mapInArrow(quantiles._counter([o]), quantiles._COUNTS).count() <= 2 * 40
    plan = quantiles._count(values, [o])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort " not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert quantiles.exact_quantiles(df, ["a", "b"], [0.5]).count() == 0


def test_fit_transform_equals_fit_then_transform(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *[None if rng.random() < 0.2 else float(v) for v in rng.normal(0, 1, 3)], f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, extra string")
    model, out = Preprocessor(n_neighbors=3).fit_transform(df, "id", ["a", "b", "c"])
    twice = Preprocessor(n_neighbors=3).fit(df, "id", ["a", "b", "c"]).transform(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, twice.collect()))
    assert model.features == ["a", "b", "c"]
