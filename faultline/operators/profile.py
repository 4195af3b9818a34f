"""Drift against a stored profile: the baseline table is read again only for close columns.

A profile holds one row per column: how many values and missing values there are, and a
mergeable KLL quantile sketch of the values.  It is built once, kept beside a snapshot
(``save_profile``), and profiles of parts add up (``merge_profiles``).

``drift_by_profile`` sketches the current table and bounds each column's two-sample
statistic from the two sketches.  With ``F(x)`` a column's distribution function and
``q_0 .. q_m`` the sketch's quantiles at ``0, 1/m, .., 1``, the number of quantiles not above
``x`` bounds ``F(x)`` within ``1/m`` plus the sketch's rank error, and stays the same until the
next quantile of either sketch; so the bounds hold for every ``x``, ties included.  If the
p-values at both bounds lie on the same side of the threshold, the verdict is settled.  The
other columns get the exact test on both tables.

Rank errors: a sketch of at most ``k`` values is exact.  Beyond that a rank is off by more than
``2.296 / k**0.9021`` with probability 1 % (the sketch's published bound); 2.5 times that
is allowed here, some six standard deviations.  Sketched are the types that a double
holds exactly (floats, whole numbers up to 32 bits, decimals of up to 15 digits); columns of other
types always get the exact test.  NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.stats import ks_pvalue
from faultline.operators.drift import column_names, ks_drift_report, long_form
from faultline.session import shared_table, ship_package

SKETCH_K = 4096
STEPS = 2000  # quantiles of a sketch that are compared
ERROR_FACTOR = 2.5
_SALTS = 64  # first-level groups a column's sketches are merged in
RESULT = ["column", "n_base", "n_current", "null_base", "null_current", "d_low", "d_high", "settled", "drift_status"]


def sketchable(t: T.DataType) -> bool:
    """Whether doubles hold all values of the type exactly."""
    if isinstance(t, T.DecimalType):
        return t.precision <= 15
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType))


def profile(df: DataFrame, columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``(column, n, nulls, sketch)``, one row per column, in one pass over ``df``.

    Tasks send one sketch per column; these are merged in up to 64 groups a column, and
    the groups then with each other."""
    cols = list(columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    odd = [c for c in cols if not sketchable(types[c])]
    if odd:
        raise ValueError(f"columns a sketch of doubles cannot hold exactly: {odd}")
    cells = long_form(df, cols).withColumn("_salt", F.spark_partition_id() % _SALTS)
    parts = cells.groupBy("col_idx", "_salt").agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")
    )
    merged = parts.groupBy("col_idx").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), _merged())
    names = column_names(df.sparkSession, cols)
    zero = F.lit(0).cast("long")
    return names.join(merged, "col_idx", "left").select(
        "column", F.coalesce("n", zero).alias("n"), F.coalesce("nulls", zero).alias("nulls"), "sketch"
    )


def _merged():
    """The merged sketch; NULL where no part has a value."""
    return F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("sketch")


def merge_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """The profile of all rows of several disjoint tables."""
    both = reduce(DataFrame.unionByName, profiles)
    return both.groupBy("column").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), _merged())


def save_profile(table_profile: DataFrame, path: str) -> None:
    table_profile.coalesce(1).write.mode("overwrite").parquet(path)  # one row per column


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _rank_error(n: str, k: int):
    return F.when(F.col(n) <= k, F.lit(0.0)).otherwise(F.lit(ERROR_FACTOR * 2.296 / k**0.9021))


def statistic_bounds(base: DataFrame, current: DataFrame, k: int = SKETCH_K, steps: int = STEPS) -> DataFrame:
    """``(column, n_base, n_current, null_base, null_current, d_low, d_high)`` from two profiles.

    ``d_low`` and ``d_high`` are NULL where a side has no value."""
    grid = F.array(*[F.lit(i / steps) for i in range(steps + 1)])

    def quantiles(p: DataFrame, side: int) -> DataFrame:
        q = p.filter("n > 0").select("column", F.explode(F.kll_sketch_get_quantile_double("sketch", grid)).alias("x"))
        return q.groupBy("column", "x").agg(F.count("*").alias("w")).select(
            "column", "x", *[(F.col("w") if s == side else F.lit(0)).cast("long").alias(f"w{s}") for s in (1, 2)]
        )

    points = quantiles(base, 1).unionByName(quantiles(current, 2)).groupBy("column", "x").agg(F.sum("w1").alias("w1"), F.sum("w2").alias("w2"))
    # At most 2 (steps + 1) points a column.
    upto = Window.partitionBy("column").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    seen = points.select("column", F.sum("w1").over(upto).alias("s1"), F.sum("w2").over(upto).alias("s2"))

    def low(s):  # F(x) is at least this, apart from the rank error
        return F.greatest(s - 1, F.lit(0)) / F.lit(float(steps))

    def high(s):
        return F.when(s == 0, 0.0).otherwise(F.least(s, F.lit(steps)) / F.lit(float(steps)))

    s1, s2 = F.col("s1"), F.col("s2")
    gaps = seen.groupBy("column").agg(
        F.max(F.greatest(low(s1) - high(s2), low(s2) - high(s1))).alias("least"), F.max(F.greatest(high(s1) - low(s2), high(s2) - low(s1))).alias("most")
    )
    sides = base.select("column", F.col("n").alias("n_base"), F.col("nulls").alias("null_base")).join(
        current.select("column", F.col("n").alias("n_current"), F.col("nulls").alias("null_current")), "column"
    )
    slack = _rank_error("n_base", k) + _rank_error("n_current", k)
    some = (F.col("n_base") > 0) & (F.col("n_current") > 0)
    return sides.join(gaps, "column", "left").select(
        "column", "n_base", "n_current", "null_base", "null_current",
        F.when(some, F.greatest(F.col("least") - slack, F.lit(0.0))).alias("d_low"),
        F.when(some, F.least(F.col("most") + slack, F.lit(1.0))).alias("d_high"),
    )


def drift_by_profile(
    stored: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    load_base: Callable[[], DataFrame],
    threshold: float = 0.05,
    nan_policy: str = "omit",
    pvalue_method: str = "auto",
    k: int = SKETCH_K,
) -> DataFrame:
    """The verdicts of ``ks_drift_report``, with the bounds that settled them.

    ``stored`` is the baseline's profile, built with ``k``.  ``load_base`` is called only if some column is not settled
    by the profiles, and its table is then read for those columns alone; their ``settled`` is
    false and both bounds are the exact statistic."""
    if nan_policy not in ("omit", "propagate"):
        raise ValueError("nan_policy must be 'omit' or 'propagate'")
    cols = list(columns)
    spark = current.sparkSession
    ship_package(spark)
    types = {f.name: f.dataType for f in current.schema.fields}
    held = {r["column"] for r in stored.select("column").collect()}  # one row per column
    fast = [c for c in cols if c in held and sketchable(types[c])]
    bounds = statistic_bounds(stored.filter(F.col("column").isin(fast)), shared_table(profile(current, fast, k), "profile"), k)
    if nan_policy == "propagate":
        whole = (F.col("null_base") + F.col("null_current")) == 0
        bounds = bounds.withColumn("d_low", F.when(whole, F.col("d_low"))).withColumn("d_high", F.when(whole, F.col("d_high")))
    n = (F.col("n_base"), F.col("n_current"))
    bounds = bounds.withColumn("_p_most", ks_pvalue(F.col("d_low"), *n, pvalue_method)).withColumn("_p_least", ks_pvalue(F.col("d_high"), *n, pvalue_method))
    drifts, stays = F.col("_p_most") < threshold, F.col("_p_least") >= threshold
    settled = F.coalesce(drifts | stays, F.col("d_low").isNull())
    report = shared_table(
        bounds.withColumn("settled", settled).withColumn("drift_status", F.coalesce(drifts, F.lit(False))).select(*RESULT), "bounds"
    )
    done = {r["column"] for r in report.filter("settled").select("column").collect()}  # one row per column
    close = [c for c in cols if c not in done]
    if not close:
        return report
    exact = ks_drift_report(load_base().select(*close), current.select(*close), close, threshold, nan_policy, pvalue_method)
    d = F.col("d_statistic")
    return report.filter("settled").unionByName(
        exact.withColumn("settled", F.lit(False)).withColumn("d_low", d).withColumn("d_high", d).select(*RESULT)
    )
