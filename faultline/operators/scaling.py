"""Exact robust scaling: ``(x - median) / (q75 - q25)``.

Quantiles are exact with linear interpolation between order statistics
(NumPy's default).  Spark's ``percentile`` aggregate would keep every distinct
value of a column in one task's memory; instead histograms of the values' leading bits are
refined around the wanted ranks (see ``quantiles``), without a sort or an exchange of rows.
``method="approx"`` uses ``percentile_approx`` (one bounded-memory pass).

Zero (or near-zero) IQR divides by 1, as scikit-learn does; Spark ML's
``RobustScaler`` differs (approximate quantiles, no centring by default,
zero-IQR columns become 0), so it is not used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.quantiles import exact_quantiles

_EPS10 = 10 * 2.220446049250313e-16


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10000) -> DataFrame:
    cols = list(columns)
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    agg = df.agg(*[F.percentile_approx(F.col(c).cast("double"), prob_arr, accuracy).alias(c) for c in cols])
    long = agg.unpivot([], cols, "column", "qs")
    return long.select("column", F.posexplode("qs").alias("i", "value")).select(
        "column", F.element_at(prob_arr, F.col("i") + 1).alias("prob"), "value"
    )


def robust_scaler_params(
    df: DataFrame,
    columns: Sequence[str],
    quantile_range: tuple[float, float] = (25.0, 75.0),
    method: str = "exact",
) -> DataFrame:
    """Fitted state ``(column, center, scale)``, one row per column."""
    lo_p, hi_p = quantile_range[0] / 100.0, quantile_range[1] / 100.0
    probs = [lo_p, 0.5, hi_p]
    q = exact_quantiles(df, columns, probs) if method == "exact" else approx_quantiles(df, columns, probs)
    wide = q.groupBy("column").agg(
        F.max(F.when(F.col("prob") == lo_p, F.col("value"))).alias("q_lo"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("center"),
        F.max(F.when(F.col("prob") == hi_p, F.col("value"))).alias("q_hi"),
    )
    iqr = F.col("q_hi") - F.col("q_lo")
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    # One row per column on both sides: broadcast the fitted side.
    return names.join(F.broadcast(wide), "column", "left").select(
        "column", "center", F.when(iqr < _EPS10, F.lit(1.0)).otherwise(iqr).alias("scale")
    )


@dataclass
class RobustScalerModel:
    """Fitted robust scaler; the state is one small row per column."""

    center: dict[str, float | None]
    scale: dict[str, float | None]

    @property
    def columns(self) -> list[str]:
        return list(self.center)

    def transform(self, df: DataFrame) -> DataFrame:
        """One projection; non-feature columns pass through, NULLs stay NULL."""
        def scaled(c: str):
            ce, sc = self.center.get(c), self.scale.get(c)
            if ce is None or sc is None:
                return F.lit(None).cast("double").alias(c)
            return ((F.col(c).cast("double") - F.lit(ce)) / F.lit(sc)).alias(c)

        return df.select(*[scaled(c) if c in self.center else F.col(c) for c in df.columns])

    def params_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.center[c], self.scale[c]) for c in self.columns]
        return spark.createDataFrame(rows, "column string, center double, scale double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.params_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def from_params(cls, params: DataFrame, order: Sequence[str] | None = None) -> "RobustScalerModel":
        rows = {r["column"]: r for r in params.collect()}  # one row per column
        names = list(order) if order is not None else sorted(rows)
        return cls({c: rows[c]["center"] for c in names}, {c: rows[c]["scale"] for c in names})

    @classmethod
    def load(cls, spark: SparkSession, path: str, order: Sequence[str] | None = None) -> "RobustScalerModel":
        return cls.from_params(spark.read.parquet(path), order)


class RobustScaler:
    def __init__(self, quantile_range: tuple[float, float] = (25.0, 75.0), method: str = "exact"):
        self.quantile_range = quantile_range
        self.method = method

    def fit(self, df: DataFrame, columns: Sequence[str]) -> RobustScalerModel:
        params = robust_scaler_params(df, columns, self.quantile_range, self.method)
        return RobustScalerModel.from_params(params, order=columns)
