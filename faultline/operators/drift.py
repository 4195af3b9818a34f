"""Two-sample Kolmogorov-Smirnov drift report for every column in one plan.

Plan: one scan, unpivoted to ``(column, value, side)``, is counted per
``(column, value)`` and side (map-side partial aggregation collapses repeated
readings before the shuffle) and written; from these counts take exact cumulative counts per column with
the range-partitioned running totals (no per-column task), then
``D = max |F_base - F_current|`` per column and its p-value.  Ties are handled by comparing cumulative counts only at
distinct values, which is what a searchsorted-based KS computes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.stats import ks_pvalue
from faultline.operators.ranking import running_totals
from faultline.session import shared_table, ship_package

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

REPORT_COLUMNS = [
    "column",
    "n_base",
    "n_current",
    "null_base",
    "null_current",
    "d_statistic",
    "p_value",
    "drift_status",
]


def _kind(t: T.DataType) -> str:
    """How values of a type are compared: ``exact`` (whole and decimal numbers, which
    a double would merge above 2**53), ``double`` or ``string``."""
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "double"
    return "exact" if isinstance(t, NUMERIC_TYPES) else "string"


_SQL_TYPE = {"double": "double", "exact": "decimal(38,10)", "string": "string"}


def _cell(c: str, kind: str, kinds: Sequence[str]):
    """A cell as a comparable value.  If the columns are of several kinds, a struct
    with one field per kind and one of them set (structs order field by field,
    so the values of one column keep their own order)."""
    v = F.col(c).cast(_SQL_TYPE[kind])
    if kind == "double":
        v = F.nanvl(v, F.lit(None).cast("double"))  # NaN is missing
    if len(kinds) == 1:
        return v
    fields = [(v if k == kind else F.lit(None).cast(_SQL_TYPE[k])).alias(k) for k in kinds]
    return F.when(v.isNotNull(), F.struct(*fields))


def long_form(df: DataFrame, cols: Sequence[str], kinds: Sequence[str] | None = None, side: str | None = None) -> DataFrame:
    """``(col_idx int, value)`` rows, one per cell, with ``_side`` if ``side`` is given.  Columns travel as their
    position, not their name: a fixed-width int key keeps the shuffle of
    (column, value) pairs small and cheap to hash; names are joined back
    from a one-row-per-column table at the end."""
    kinds = list(kinds) if kinds is not None else ["double"] * len(cols)
    all_kinds = sorted(set(kinds))
    keep = [F.col(side).alias("_side")] if side is not None else []
    cells = [_cell(c, k, all_kinds).alias(str(i)) for i, (c, k) in enumerate(zip(cols, kinds))]
    names = ["_side"] if keep else []
    out = df.select(*keep, *cells).unpivot(names, [str(i) for i in range(len(cols))], "_fl_col", "value")
    return out.select(F.col("_fl_col").cast("int").alias("col_idx"), "value", *names)


def column_names(spark, cols: Sequence[str]) -> DataFrame:
    """``(col_idx, column)``: one row per tested column, safe to broadcast."""
    return F.broadcast(spark.createDataFrame(list(enumerate(cols)), "col_idx int, column string"))


def _ks_chain(df: DataFrame, side: str, cols: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    counts = long_form(df, cols, kinds, side).groupBy("col_idx", "value").agg(
        F.count_if(~F.col("_side")).alias("c1"),
        F.count_if(F.col("_side")).alias("c2"),
    )
    # The distinct readings are counted once and written; both branches below read them.
    counts = shared_table(counts, "ks-counts")
    stats = counts.groupBy("col_idx").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("c1"))).alias("n_base"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("c2"))).alias("n_current"),
        F.sum(F.when(F.col("value").isNull(), F.col("c1"))).alias("null_base"),
        F.sum(F.when(F.col("value").isNull(), F.col("c2"))).alias("null_current"),
    ).select(
        "col_idx", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_base", "n_current", "null_base", "null_current")]
    )
    # One row per tested column: a proven bound, so broadcasting is safe.
    stats = F.broadcast(stats)
    cum = running_totals(counts.filter(F.col("value").isNotNull()), ["col_idx"], ["value"], ["c1", "c2"], groups_bounded=True)
    d = (
        cum.join(stats, "col_idx")
        .groupBy("col_idx")
        .agg(
            F.max(
                F.abs(
                    F.try_divide(F.col("cum_c1").cast("double"), F.col("n_base"))
                    - F.try_divide(F.col("cum_c2").cast("double"), F.col("n_current"))
                )
            ).alias("d_statistic")
        )
    )
    names = column_names(df.sparkSession, cols)
    return names.join(stats, "col_idx").join(F.broadcast(d), "col_idx", "left").drop("col_idx")


def ks_drift_report(
    base: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = 0.05,
    nan_policy: str = "omit",
    pvalue_method: str = "auto",
) -> DataFrame:
    """Per-column KS drift report of ``current`` against ``base`` (two tables).

    For two parts of one table use ``ks_drift_by_side``, which scans it once."""
    cols = list(columns) if columns is not None else [c for c in base.columns if c in set(current.columns)]
    missing = [c for c in cols if c not in base.columns or c not in current.columns]
    if missing:
        raise ValueError(f"columns missing from one side: {missing}")
    both = base.select(F.lit(False).alias("_fl_side"), *cols).unionByName(current.select(F.lit(True).alias("_fl_side"), *cols))
    return ks_drift_by_side(both, "_fl_side", cols, threshold, nan_policy, pvalue_method)


def ks_drift_by_side(
    df: DataFrame,
    side: str,
    columns: Sequence[str],
    threshold: float = 0.05,
    nan_policy: str = "omit",
    pvalue_method: str = "auto",
) -> DataFrame:
    """Per-column KS drift report of the rows where the boolean column ``side`` is true
    against those where it is false; one scan of ``df`` (rows with a null side are
    left out).

    Columns: ``column, n_base, n_current, null_base, null_current,
    d_statistic, p_value, drift_status``.  All columns share one plan, mixed
    numeric and text columns included.  ``drift_status`` is
    ``p_value < threshold`` (false when the p-value is undefined).

    ``nan_policy="omit"`` tests the non-missing values.  ``"propagate"``
    reproduces the reference: any missing value on either side makes the
    statistic and the p-value undefined (NULL here), so the column can never
    be flagged.  Floating-point columns are compared as doubles, whole and
    decimal numbers exactly, other columns by their string order.
    """
    if nan_policy not in ("omit", "propagate"):
        raise ValueError("nan_policy must be 'omit' or 'propagate'")
    cols = list(columns)
    ship_package(df.sparkSession)
    types = {f.name: f.dataType for f in df.schema.fields}
    report = _ks_chain(df.filter(F.col(side).isNotNull()), side, cols, [_kind(types[c]) for c in cols])
    d = F.col("d_statistic")
    if nan_policy == "propagate":
        d = F.when((F.col("null_base") + F.col("null_current")) == 0, d)
    report = report.withColumn("d_statistic", d)
    p = ks_pvalue(F.col("d_statistic"), F.col("n_base"), F.col("n_current"), pvalue_method)
    return report.withColumn("p_value", p).withColumn(
        "drift_status", F.coalesce(F.col("p_value") < F.lit(threshold), F.lit(False))
    ).select(*REPORT_COLUMNS)


def drift_verdict(report: DataFrame) -> DataFrame:
    """One row: ``no_drift`` is true only when no column drifted."""
    return report.agg(
        F.coalesce(F.bool_and(~F.col("drift_status")), F.lit(True)).alias("no_drift"),
        F.count_if(F.col("drift_status")).alias("n_drifted"),
        F.count("*").alias("n_columns"),
    )
